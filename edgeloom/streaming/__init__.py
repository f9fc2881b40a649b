"""Streaming jobs: functions of batch or streaming frames, sinks and the runner."""

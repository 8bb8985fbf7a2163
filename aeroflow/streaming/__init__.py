"""Structured Streaming jobs that fill the tables, and their health figures."""

from aeroflow.streaming.current import current_job
from aeroflow.streaming.ingest import AIRPORT_JOB, FLIGHT_JOB, ingest, run_to_end, start
from aeroflow.streaming.landing import LandedTopic
from aeroflow.streaming.panels import PANEL_JOB

__all__ = ["AIRPORT_JOB", "FLIGHT_JOB", "LandedTopic", "PANEL_JOB", "current_job", "ingest", "run_to_end", "start"]

"""Incremental runs over sales text files and event files arriving in a folder."""

from tillroll.streaming.events import start_session_stream, start_window_stream
from tillroll.streaming.ingest import STREAMABLE, start_report_stream, streaming_sales
from tillroll.streaming.state_stream import STATE_STREAMABLE, start_state_stream

__all__ = [
    "STATE_STREAMABLE",
    "STREAMABLE",
    "start_report_stream",
    "start_session_stream",
    "start_state_stream",
    "start_window_stream",
    "streaming_sales",
]

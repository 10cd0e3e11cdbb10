from .joblog_stream import start_report_ingest

__all__ = ["start_report_ingest"]

from driftline.streaming.runner import start_ingest, batch_tag_for

__all__ = ["start_ingest", "batch_tag_for"]

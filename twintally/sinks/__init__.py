from twintally.sinks.summary import SUMMARY_SCHEMA, append_by_folder, append_summary, read_summary

__all__ = ["SUMMARY_SCHEMA", "append_by_folder", "append_summary", "read_summary"]

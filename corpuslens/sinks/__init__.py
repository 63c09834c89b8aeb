from corpuslens.sinks.tables import export_csv, publish_run, read_table, resolve_run_id, run_path, saved_run, write_table

__all__ = ["export_csv", "publish_run", "read_table", "resolve_run_id", "run_path", "saved_run", "write_table"]

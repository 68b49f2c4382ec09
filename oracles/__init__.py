"""The same results stated in SQL for an independent engine, used only for checking."""

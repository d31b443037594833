from contrail.streaming.sinks import KeyedTable  # noqa: F401

from contrail.sources.dimension import pin_dimension, read_aircraft_csv, write_aircraft_csv  # noqa: F401
from contrail.sources.messages import decode_messages, read_kafka, read_message_files, to_messages  # noqa: F401
from contrail.sources.snapshot import (  # noqa: F401
    decode_replay, decode_snapshot, read_replay, snapshot_documents, state_vectors,
)

"""Sources: inline collections, number sequences, text files, socket, Kafka, tables."""

from streamkit.sources.collection import from_collection, from_elements, from_iterator, generate_sequence
from streamkit.sources.iterators import from_iterators
from streamkit.sources.text import read_text_file, read_file, read_text_stream
from streamkit.sources.external import socket_text_stream, kafka_source, kafka_options
from streamkit.sources.ordered import TimeOrderedSource, time_ordered_stream
from streamkit.sources.tables import ensure_parallelism, load_events, load_table

__all__ = [
    "from_collection", "from_elements", "from_iterator", "from_iterators", "generate_sequence",
    "read_text_file", "read_file", "read_text_stream",
    "socket_text_stream", "kafka_source", "kafka_options",
    "TimeOrderedSource", "time_ordered_stream", "load_table", "load_events", "ensure_parallelism",
]

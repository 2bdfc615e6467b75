"""Sinks: print, text, delimited, socket, custom output format, Kafka."""

from streamkit.sinks.files import write_text, write_delimited, delimited_lines
from streamkit.sinks.printing import print_rows, print_to_err
from streamkit.sinks.custom import OutputFormat, write_using_output_format, write_to_socket, socket_connection
from streamkit.sinks.kafka import kafka_sink
from streamkit.sinks.transactional import LineFormat, StagedFormat, committed_parts, read_committed, write_transactional

__all__ = [
    "write_text", "write_delimited", "delimited_lines", "print_rows", "print_to_err", "OutputFormat",
    "write_using_output_format", "write_to_socket", "socket_connection", "kafka_sink",
    "StagedFormat", "LineFormat", "write_transactional", "committed_parts", "read_committed",
]

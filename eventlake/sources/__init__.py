"""Where messages come from."""

from eventlake.sources.files import landed_messages, text_messages
from eventlake.sources.kafka import kafka_options, kafka_messages, starting_offsets

__all__ = [
    "kafka_messages",
    "kafka_options",
    "landed_messages",
    "starting_offsets",
    "text_messages",
]

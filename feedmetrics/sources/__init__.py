from feedmetrics.sources.files import (  # noqa: F401
    read_table,
    read_log_lines,
    read_dictionary,
    read_documents,
    read_feed,
    DICTIONARY_SCHEMA,
)
from feedmetrics.sources.topics import TopicSpec, read_topic, KAFKA_SCHEMA  # noqa: F401

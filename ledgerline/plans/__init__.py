"""Composite jobs built from the operators, sources and sinks."""

from ledgerline.plans.buckets import merge_bucketed_version, write_bucketed
from ledgerline.plans.publish import publish
from ledgerline.plans.replay import decode_messages, minute_text_to_epoch, replay_and_merge, replay_kafka_time, replay_offsets, replay_time
from ledgerline.plans.versions import merge_chain_version, merge_version, version_stamp

__all__ = [
    "decode_messages", "merge_bucketed_version", "merge_chain_version", "merge_version", "minute_text_to_epoch", "publish", "replay_and_merge", "replay_kafka_time",
    "replay_offsets", "replay_time", "version_stamp", "write_bucketed",
]

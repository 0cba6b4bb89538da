"""Fixed schemas; nothing is inferred."""

from __future__ import annotations

LIST_ITEM = "eid string, id string, message_id string, raw_body string, body string, html string"
EXPORT = ("eid", "thread_id", "grouping_method", "from_addr", "to_addr", "cc_addr", "subject", "date", "timestamp", "reply_depth", "participant_count", "participants_str", "cleaned_body", "body_text")

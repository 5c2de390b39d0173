from churnframe.streaming.scoring import stamp_requests, start, with_stable_ids  # noqa: F401

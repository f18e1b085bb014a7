"""Row-level column functions; none of them needs a shuffle."""

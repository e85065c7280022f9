from .landing import compact, landed, landing, manifest, rejected_messages
from .metrics import BatchMetrics
from .run import observations, start_console, start_stream

__all__ = [
    "BatchMetrics",
    "compact",
    "landed",
    "landing",
    "manifest",
    "observations",
    "rejected_messages",
    "start_console",
    "start_stream",
]

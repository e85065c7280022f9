from .jdbc import jdbc_append, jdbc_landing, jdbc_refresh, jdbc_refresh_all, transaction
from .tables import current, publish, recover, swap_all, swap_in

__all__ = [
    "current",
    "jdbc_append",
    "jdbc_landing",
    "jdbc_refresh",
    "jdbc_refresh_all",
    "publish",
    "recover",
    "swap_all",
    "swap_in",
    "transaction",
]

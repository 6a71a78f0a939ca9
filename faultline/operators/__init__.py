from faultline.operators import (
    alerts,
    cleaning,
    curves,
    fieldlog,
    metrics,
    policy,
    profile,
    quality,
    ranking,
    reports,
    risk,
    splitting,
)

__all__ = [
    "alerts",
    "cleaning",
    "curves",
    "fieldlog",
    "metrics",
    "policy",
    "profile",
    "quality",
    "ranking",
    "reports",
    "risk",
    "splitting",
]

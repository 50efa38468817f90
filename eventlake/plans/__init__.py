"""Registered queries (key -> Spark callable + SQL oracle) and batch jobs."""


def load_all():
    """Import every query module so the registry is complete."""
    from eventlake.plans import batch_queries, event_queries, report_queries, stream_queries  # noqa: F401

    from eventlake.plans.registry import REGISTRY

    return REGISTRY

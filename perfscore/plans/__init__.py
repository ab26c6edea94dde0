"""Driver keys (queries + DuckDB oracles) over the fixture views."""

from perfscore.plans.registry import ORACLES, QUERIES


def load_all() -> None:
    """Import every key module so that its keys register themselves."""
    from perfscore.plans import (  # noqa: F401
        chain_keys,
        explore_keys,
        feature_keys,
        ingest_keys,
        io_keys,
        label_keys,
        model_keys,
        present_keys,
        scoring_keys,
        stream_keys,
    )


__all__ = ["QUERIES", "ORACLES", "load_all"]

"""SQL restatements of the registered queries, for the side-by-side check."""

from __future__ import annotations


def all_oracles() -> dict[str, str]:
    from oracle import frames, market, reference, streams
    texts = {**market.oracles(), **reference.oracles(), **frames.oracles(), **streams.oracles()}
    # the status report reads the same roll-ups back from stored metadata
    for section, same_as in (("venue_status", "health_latest"), ("coverage", "coverage_by_table"),
                             ("quality", "quality_latest"), ("corrections", "corrections_rollup")):
        texts[f"status_{section}"] = texts[same_as]
    texts["status_fallback"] = texts["status_coverage"]
    return texts

"""The registered queries: each operator on the supplied tables, beside the SQL it must agree with."""

from __future__ import annotations

from registry import dimensions, facts, ingestion, quality, ranges, scalars, staged, warehouse
from registry.register import Entry

ENTRIES: dict[str, Entry] = {
    **facts.ENTRIES,
    **dimensions.ENTRIES,
    **scalars.ENTRIES,
    **staged.ENTRIES,
    **ingestion.ENTRIES,
    **quality.ENTRIES,
    **ranges.ENTRIES,
    **warehouse.ENTRIES,
}

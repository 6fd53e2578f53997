"""SQL counterparts of the registered queries, for comparison on another engine."""

from __future__ import annotations

import re
from pathlib import Path

FOLDER = Path(__file__).parent


def statements() -> dict[str, str]:
    """Name -> statement: the derived tables, the shared parts and the query itself."""
    shared = (FOLDER / "derived.sql").read_text("utf8") + (FOLDER / "shared.sql").read_text("utf8")
    found: dict[str, str] = {}
    for path in sorted(FOLDER.glob("queries_*.sql")):
        for block in path.read_text("utf8").split("-- name: ")[1:]:
            name, body = block.split("\n", 1)
            found[name.strip()] = shared + body.strip()
    # By-customer reports on listed customers: the listed parts of the whole.
    by_customer = [name for name in found if re.fullmatch(r"r\d+(_1|_orders)?_by_customer", name)]
    found |= {f"{name}_listed": f"SELECT * FROM ({found[name]}) AS parts WHERE customer_id % 10 < 5" for name in by_customer}
    return found

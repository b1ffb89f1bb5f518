"""SQL text per registered query."""

from __future__ import annotations

from oracle.bronze import BRONZE
from oracle.gold import GOLD
from oracle.reports import REPORTS
from oracle.silver import SILVER
from oracle.sql import compose

_CTES = {**BRONZE, **SILVER, **GOLD}


def statements() -> dict[str, str]:
    finals = {
        **{f"silver_{name[2:]}": f"SELECT * FROM {name}" for name in SILVER},
        **{name[2:]: f"SELECT * FROM {name}" for name in GOLD if name.startswith("g_")},
        **REPORTS,
    }
    return {name: compose(sql, _CTES) for name, sql in finals.items()}

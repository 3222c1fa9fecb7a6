"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

from .decontaminate import ORACLE_SQL as _decontaminate
from .middle import ORACLE_SQL as _middle
from .quality import ORACLE_SQL as _quality
from .warc import ORACLE_SQL as _warc

ORACLE: dict[str, str] = {
    "op3_quality": _quality,
    "op4_decontaminate": _decontaminate,
    "op10_warc": _warc,
    "op12_middle": _middle,
}

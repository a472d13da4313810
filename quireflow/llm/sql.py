"""DuckDB SQL for those queries of this subpackage that SQL can express."""

from __future__ import annotations

from . import filter_audit, mixing, passage_dedup, turn_repair, warc

ORACLES: dict[str, str] = {"op7_warc": warc.ORACLE, "op10_source_mixing": mixing.ORACLE, "op11_turn_repair": turn_repair.ORACLE, "op12_passage_dedup": passage_dedup.ORACLE, "op13_filter_audit": filter_audit.ORACLE}

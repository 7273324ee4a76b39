"""The queries of the training-data operators and their SQL."""

from __future__ import annotations

from lexiforge.llm.exact_dedup import OP6_SQL, op6_exact_dedup
from lexiforge.llm.licenses import OP5_SQL, op5_license_scan
from lexiforge.llm.mixing import op3_mixing
from lexiforge.llm.packing import op1_packing
from lexiforge.llm.quality import op8_quality
from lexiforge.llm.simhash import op10_simhash
from lexiforge.llm.suffix_dedup import op7_suffix_dedup
from lexiforge.llm.url_rules import OP2_SQL, op2_url_rules
from lexiforge.llm.warc import OP4_SQL, op4_warc
from lexiforge.llm.winnow import op9_winnowing

_ALL = (op1_packing, op2_url_rules, op3_mixing, op4_warc, op5_license_scan, op6_exact_dedup, op7_suffix_dedup, op8_quality, op9_winnowing, op10_simhash)


def queries() -> dict:
    return {f.__name__: f for f in _ALL}


def oracle_sql() -> dict:
    return {"op2_url_rules": OP2_SQL, "op4_warc": OP4_SQL, "op5_license_scan": OP5_SQL, "op6_exact_dedup": OP6_SQL}

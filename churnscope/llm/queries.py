"""The registered queries of the text operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from churnscope.llm.op1_html import op1_html
from churnscope.llm.op2_minhash import op2_minhash
from churnscope.llm.op3_quality import op3_quality
from churnscope.llm.op4_onebit import op4_onebit
from churnscope.llm.op5_chosen_path import op5_chosen_path
from churnscope.llm.op6_fixity import OP6_SQL, op6_fixity
from churnscope.llm.op7_language import op7_language
from churnscope.llm.op8_packing import op8_packing
from churnscope.llm.op9_line_dedup import OP9_SQL, op9_line_dedup
from churnscope.llm.op10_bpe import op10_bpe
from churnscope.llm.op11_setm import OP11_SQL, op11_setm
from churnscope.llm.op12_bpa import OP12_SQL, op12_bpa
from churnscope.llm.op13_rules import op13_rules

_QUERIES = [op1_html, op2_minhash, op3_quality, op4_onebit, op5_chosen_path, op6_fixity, op7_language, op8_packing, op9_line_dedup, op10_bpe,
            op11_setm, op12_bpa, op13_rules]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {fn.__name__: fn for fn in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op6_fixity": OP6_SQL, "op9_line_dedup": OP9_SQL, "op11_setm": OP11_SQL, "op12_bpa": OP12_SQL}

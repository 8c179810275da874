"""The registered queries of the training-data operators, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weekloom.llm.bitslice import SQL as OP2_SQL
from weekloom.llm.bitslice import op2_bitslice_topk
from weekloom.llm.langid import op4_langid
from weekloom.llm.lexical import SQL as OP11_SQL
from weekloom.llm.lexical import op11_lexical
from weekloom.llm.main_text import op12_main_text
from weekloom.llm.merkle import SQL as OP13_SQL
from weekloom.llm.merkle import op13_merkle
from weekloom.llm.mixing import op10_mixing
from weekloom.llm.packing import op3_packing
from weekloom.llm.pii import op1_pii
from weekloom.llm.quality import op5_quality
from weekloom.llm.simhash import op8_simhash
from weekloom.llm.stable_nn import op6_stable_nn
from weekloom.llm.token_files import op7_token_files
from weekloom.llm.toxicity import op9_toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_pii": op1_pii,
        "op2_bitslice_topk": op2_bitslice_topk,
        "op3_packing": op3_packing,
        "op4_langid": op4_langid,
        "op5_quality": op5_quality,
        "op6_stable_nn": op6_stable_nn,
        "op7_token_files": op7_token_files,
        "op8_simhash": op8_simhash,
        "op9_toxicity": op9_toxicity,
        "op10_mixing": op10_mixing,
        "op11_lexical": op11_lexical,
        "op12_main_text": op12_main_text,
        "op13_merkle": op13_merkle,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_bitslice_topk": OP2_SQL, "op11_lexical": OP11_SQL, "op13_merkle": OP13_SQL}

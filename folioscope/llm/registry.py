"""The corpus operators' queries and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folioscope.llm.bpe import op5_bpe
from folioscope.llm.decontamination import OP3_SQL, op3_decontamination
from folioscope.llm.jaccard import OP10_SQL, op10_jaccard
from folioscope.llm.language import op4_language
from folioscope.llm.manifest import OP11_SQL, op11_manifest
from folioscope.llm.media import op1_media
from folioscope.llm.near import OP13_SQL, op13_minhash
from folioscope.llm.phrases import OP12_SQL, op12_phrases
from folioscope.llm.pii import op2_pii
from folioscope.llm.repeats import OP6_SQL, op6_repeats
from folioscope.llm.secrets import op7_secrets
from folioscope.llm.sharding import op9_sharding
from folioscope.llm.toxicity import op8_toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_media": op1_media,
        "op2_pii": op2_pii,
        "op3_decontamination": op3_decontamination,
        "op4_language": op4_language,
        "op5_bpe": op5_bpe,
        "op6_repeats": op6_repeats,
        "op7_secrets": op7_secrets,
        "op8_toxicity": op8_toxicity,
        "op9_sharding": op9_sharding,
        "op10_jaccard": op10_jaccard,
        "op11_manifest": op11_manifest,
        "op12_phrases": op12_phrases,
        "op13_minhash": op13_minhash,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_decontamination": OP3_SQL, "op6_repeats": OP6_SQL, "op10_jaccard": OP10_SQL, "op11_manifest": OP11_SQL, "op12_phrases": OP12_SQL, "op13_minhash": OP13_SQL}

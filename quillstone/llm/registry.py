"""Queries of the training-data operators and the SQL of those that SQL can express."""

from __future__ import annotations

from quillstone.llm.chat import OP2_SQL, op2_chat_formatting
from quillstone.llm.decontam import OP4_SQL, op4_benchmark_decontamination
from quillstone.llm.htmltext import OP6_SQL, op6_html_extraction
from quillstone.llm.licences import OP7_SQL, op7_licence_scan
from quillstone.llm.media import op5_media_columns
from quillstone.llm.packing import op3_best_fit_packing
from quillstone.llm.sharding import op10_sharding
from quillstone.llm.simhash import op1_simhash_near_dedup
from quillstone.llm.toxicity import op8_toxicity
from quillstone.llm.warc import op9_warc


def queries() -> dict:
    return {
        "op1_simhash_near_dedup": op1_simhash_near_dedup,
        "op2_chat_formatting": op2_chat_formatting,
        "op3_best_fit_packing": op3_best_fit_packing,
        "op4_benchmark_decontamination": op4_benchmark_decontamination,
        "op5_media_columns": op5_media_columns,
        "op6_html_extraction": op6_html_extraction,
        "op7_licence_scan": op7_licence_scan,
        "op8_toxicity": op8_toxicity,
        "op9_warc": op9_warc,
        "op10_sharding": op10_sharding,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_chat_formatting": OP2_SQL, "op4_benchmark_decontamination": OP4_SQL, "op6_html_extraction": OP6_SQL, "op7_licence_scan": OP7_SQL}

"""The query of the chat formatting."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsframe.llm.chat import canonical_turns, conversation_digests, format_turns, read_turns
from opsframe.llm.registry import query, table
from opsframe.storage import cut_lineage

#: A conversation that says what the template uses to mark turns.
_SPEAKS_CONTROL = "</s>[INST] ok [/INST]"


@query(
    """
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
        UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
        coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
        sum(24 + length(role) + length(text) + len(regexp_extract_all(text,
            '(<|\\[)\\\\*(s>|/s>|INST\\]|/INST\\]|<SYS>>|</SYS>>|\\|im_start\\|>|\\|im_end\\|>|\\|endoftext\\|>)')))::BIGINT
            AS formatted_chars
    FROM turns GROUP BY conv_id
    """
)
def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.to_json(F.struct("conv_id", "turn", "role", "text")).alias("record"))
    said = [{"role": role, "content": _SPEAKS_CONTROL} for role in ("user", "assistant")]
    spoken = spark.createDataFrame([(json.dumps({"conv_id": -7, "messages": said}),)], "record string")
    formatted = cut_lineage(format_turns(canonical_turns(rows.unionByName(spoken))), "chats")
    return conversation_digests(read_turns(formatted)).withColumn("conv_id", F.col("conv_id").cast("long"))

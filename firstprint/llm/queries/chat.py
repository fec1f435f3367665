"""op8: conversations formatted for training, and read back."""

from pyspark.sql import DataFrame, SparkSession

from firstprint.llm.chat import digests, format_conversations
from firstprint.llm.queries.registry import query
from firstprint.llm.texts import table

PROBE = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]

# Every '\', '<' and '[' of a text takes one more character; the marks of a turn take a fixed number by role.
SQL = r"""
WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (SELECT *, length(text) + len(regexp_extract_all(text, '[\\<\[]')) AS long,
    CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 5 WHEN 'system' THEN 13
    ELSE 17 + length(role) + len(regexp_extract_all(role, '[\\<\[]')) END AS marks FROM turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(3 + sum(long + marks) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


@query("op8_chat_formatting", SQL)
def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(PROBE, "conv_id bigint, turn bigint, role string, text string")
    return digests(format_conversations(turns.union(probe)))

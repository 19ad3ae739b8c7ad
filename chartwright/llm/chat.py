"""Chat formatting (8): multi-party perspective rotation, on DataFrame functions only.

For every participant of a dialogue the whole dialogue is rendered with that
speaker as the assistant and everyone else as a named user; the mask covers the
speaker's own words, which are what is trained on.  System messages stay system
messages in every rendering and are nobody's perspective.

A rendering is returned in chunks of ``chunk`` turn numbers, each with its place
in the whole: rows of (conversation, participant, chunk) with the text, its first
character's place, and the masked spans as places in the whole rendering.  Texts
are dealt by conversation and chunk, or by conversation, participant and chunk,
so a long dialogue's texts are spread over tasks; under the conversation alone
only chunk numbers, speakers and lengths meet.  Turns of one number (or none)
share a chunk, which is put together in one task.

Defined cases: a null text is empty; a null speaker is the user ``unknown`` and
nobody's perspective; a null turn sorts first, in chunk 0.  Turns of the same
number are ordered by speaker and text; repeated rows are rendered as often as
they occur.  Rows without a conversation are left out; a conversation of system
messages only has no renderings.  Further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 64
SYSTEM = "system"
UNKNOWN = "unknown"
#: The marks around a turn.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def rotate(turns: DataFrame, *, conversation_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role",
           text_col: str = "text", system: str = SYSTEM, chunk: int = CHUNK) -> DataFrame:
    """Rows (conversation, participant, chunk_no, n_turns, start, text, spans array<struct<start, end>>)."""
    rows = turns.select(
        F.col(conversation_col).alias("c"), F.col(turn_col).alias("turn"), F.coalesce(speaker_col, F.lit(UNKNOWN)).alias("speaker"),
        F.col(speaker_col).isNotNull().alias("named"), F.coalesce(text_col, F.lit("")).alias("words"),
    ).filter("c is not null")
    rows = rows.withColumn("chunk_no", F.coalesce(F.floor(F.col("turn") / chunk), F.lit(0)).cast("long"))
    # distinct speakers: pre-aggregated, one row for each speaker and task before the shuffle
    speakers = rows.filter(F.col("named") & (F.col("speaker") != system)).select("c", F.col("speaker").alias("participant")).distinct()
    # texts meet the participants under (conversation, chunk); only chunk numbers meet them under the conversation
    parts = rows.select("c", "chunk_no").distinct().join(speakers, "c")
    said = rows.join(parts, ["c", "chunk_no"])
    own = F.col("named") & (F.col("speaker") == F.col("participant"))
    head = (
        F.when(own, F.lit(f"{OPEN}assistant\n"))
        .when(F.col("named") & (F.col("speaker") == system), F.lit(f"{OPEN}system\n"))
        .otherwise(F.concat(F.lit(f"{OPEN}user name="), "speaker", F.lit("\n")))
    )
    key = ["c", "participant", "chunk_no"]
    rendered = said.withColumn("head", head).withColumn("own", own)
    # where each chunk begins: running sums of the chunks' lengths alone, which meet without the texts
    narrow = rows.select("c", "chunk_no", "speaker", "named", F.length("words").alias("n")).join(parts, ["c", "chunk_no"])
    lengths = narrow.groupBy(*key).agg(F.sum((F.length(head) + F.col("n") + len(CLOSE)).cast("long")).alias("size"))
    before = Window.partitionBy("c", "participant").orderBy("chunk_no").rowsBetween(Window.unboundedPreceding, -1)
    starts = lengths.select(*key, F.coalesce(F.sum("size").over(before), F.lit(0).cast("long")).alias("start"))
    grouped = rendered.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("turn", "speaker", "words", "head", "own"))).alias("m"))
    placed = grouped.join(starts, key)
    piece = lambda x: F.concat(x["head"], x["words"], F.lit(CLOSE))
    length = lambda x: F.length(x["head"]) + F.length(x["words"]) + len(CLOSE)
    # the masked spans in one walk over the turns; each step adds one to the list of the speaker's own
    walked = F.aggregate(
        "m", F.struct(F.col("start").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans")),
        lambda s, x: F.struct(
            (s["at"] + length(x)).alias("at"),
            F.when(x["own"], F.array_append(s["spans"], F.struct(
                (s["at"] + F.length(x["head"])).alias("start"), (s["at"] + F.length(x["head"]) + F.length(x["words"])).alias("end"))))
            .otherwise(s["spans"]).alias("spans")))
    return placed.select(
        F.col("c").alias(conversation_col), "participant", "chunk_no", F.size("m").cast("long").alias("n_turns"), "start",
        F.array_join(F.transform("m", piece), "").alias("text"), walked["spans"].alias("spans"))

"""Chat formatting: logged snapshots of growing conversations collapse into the longest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Turn markers of the rendered text; the same characters inside a turn are taken apart.
START, END = "<|im_start|>", "<|im_end|>"


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """The conversations that are no prefix of a longer one, rendered: ``conv_id, n_turns, n_copies, text``.

    ``turns`` has ``conv_id, turn, role, text``. Turns are ordered by (turn,
    role, text), NULLs first. Every turn gets a 120-bit hash of its position,
    role and text; the running XOR of these is the hash of the prefix that ends
    there. A conversation whose whole hash occurs as a shorter prefix of another
    is dropped by an anti-join. Of conversations that are equal turn by turn the
    smallest id stays and ``n_copies`` counts them.

    The running hash is a window over one conversation that streams its sorted
    rows. Equal prefixes fold in the map tasks before they are shuffled, so a
    first turn that a third of the conversations share costs no more than others.

    Markers written out in a role or a text are taken apart, and line breaks in
    a role are blanks, so that neither passes for a turn.

    NULL role is ``unknown``, NULL text is empty; both compare equal to those
    values. Repeated rows are turns of their own. A NULL id is one conversation.
    An empty table gives an empty result; further columns are ignored.
    """
    rows = turns.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("unknown")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    ordered = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    position = rows.select("conv_id", "role", "text", F.row_number().over(ordered).cast("long").alias("k"))
    code = F.sha2(F.concat_ws("\x1f", F.col("k").cast("string"), F.length("role").cast("string"), "role", "text"), 256)
    coded = position.withColumn("code", code).select(
        "conv_id", "k", *(_bits("code", i).alias(f"part{i}") for i in (0, 1))
    )
    running = Window.partitionBy("conv_id").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    prefixes = coded.select(
        "conv_id",
        "k",
        *(F.bit_xor(f"part{i}").over(running).alias(f"h{i}") for i in (0, 1)),
        F.lead("k").over(Window.partitionBy("conv_id").orderBy("k")).isNull().alias("whole"),
    )
    key = ["k", "h0", "h1"]
    proper = prefixes.where("NOT whole").select(key).distinct()
    whole = prefixes.where("whole").groupBy(key).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    kept = whole.join(proper, key, "left_anti").select("conv_id", "n_copies")
    role, text = (F.regexp_replace(c, r"<\|im_(start|end)\|>", "< |im_$1|>") for c in ("role", "text"))
    # A role is one line: what follows a line break would pass for text.
    line = F.concat(F.lit(START), F.regexp_replace(role, r"[\r\n]+", " "), F.lit("\n"), text, F.lit(END + "\n"))
    lines = position.select(F.col("conv_id").alias("id"), "k", line.alias("line"))
    return (
        lines.join(kept, F.col("id").eqNullSafe(F.col("conv_id")))
        .groupBy("conv_id", "n_copies")
        .agg(F.array_sort(F.collect_list(F.struct("k", "line"))).alias("lines"))
        .select(
            "conv_id",
            F.size("lines").cast("long").alias("n_turns"),
            "n_copies",
            F.concat_ws("", F.col("lines.line")).alias("text"),
        )
    )


def _bits(code: str, i: int) -> Column:
    return F.conv(F.substring(code, 1 + 15 * i, 15), 16, 10).cast("long")

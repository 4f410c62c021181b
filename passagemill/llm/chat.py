"""Chat formatting with a grammar round trip, in DataFrame functions only.

Grammar of a formatted conversation (one string):

    conversation = turn*
    turn         = OPEN " " body " " CLOSE newline
    user         : [INST] .. [/INST]        assistant : <s> .. </s>
    system       : <<SYS>> .. <</SYS>>      any other : [ROLE] role " [TEXT] " text .. [/ROLE]

A control string counts only where no backslash stands before it. The parser
reads turns from left to right and takes one backslash away from every run of
backslashes before a control string. Rendering adds one backslash there, but
only where it must: turns are first rendered as they are, the text is parsed,
and every turn that does not come back identical is rendered with its control
strings escaped and parsed again; what differs then is an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Control strings of the template (fixed values).
CONTROLS = ("<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "[ROLE]", "[TEXT]", "[/ROLE]")
#: Opening and closing mark of each role with marks of its own.
MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}

_ANY = "(?:" + "|".join("\\Q" + c + "\\E" for c in CONTROLS) + ")"
_FREE = rf"(?<!\\){_ANY}"
#: One turn: opening mark, body without free control strings (but [TEXT]), closing mark.
_TURN = r"(?s)(?<!\\)(<<SYS>>|\[INST\]|<s>|\[ROLE\]) (.*?) (?<!\\)(<</SYS>>|\[/INST\]|</s>|\[/ROLE\])\n"


def escape(text: Column) -> Column:
    """One more backslash before every control string, after any that stand there."""
    return F.regexp_replace(text, rf"(\\*)({_ANY})", r"\\$1$2")


def unescape(text: Column) -> Column:
    """One backslash less before every control string that has any."""
    return F.regexp_replace(text, rf"\\(\\*)({_ANY})", "$1$2")


def render_turn(role: Column, text: Column) -> Column:
    out = F.concat(F.lit("[ROLE] "), role, F.lit(" [TEXT] "), text, F.lit(" [/ROLE]\n"))
    for name, (opening, closing) in MARKS.items():
        own = F.concat(F.lit(opening + " "), text, F.lit(f" {closing}\n"))
        out = F.when(role == name, own).otherwise(out)
    return out


def parse(formatted: Column) -> Column:
    """The turns of a formatted text: array of (role, text, start, chars), unescaped.

    ``start`` and ``chars`` give the place of the escaped text in code points.
    """
    whole = F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(0))

    def read(segment: Column) -> Column:
        opening = F.regexp_extract(segment, _TURN, 1)
        body = F.regexp_extract(segment, _TURN, 2)
        closing = F.regexp_extract(segment, _TURN, 3)
        role = F.lit(None).cast("string")
        text = body
        skip = F.char_length(opening) + 1
        named = F.regexp_extract(body, r"(?s)^(.*?) (?<!\\)\[TEXT\] (.*)$", 1)
        rest = F.regexp_extract(body, r"(?s)^(.*?) (?<!\\)\[TEXT\] (.*)$", 2)
        for name, (mark, end) in MARKS.items():
            role = F.when((opening == mark) & (closing == end), F.lit(name)).otherwise(role)
        other = (opening == "[ROLE]") & (closing == "[/ROLE]") & body.rlike(r"(?s) (?<!\\)\[TEXT\] ")
        text = F.when(other, rest).otherwise(text)
        skip = F.when(other, skip + F.char_length(named) + 8).otherwise(skip)
        role = F.when(other, unescape(named)).otherwise(role)
        clean = ~text.rlike(_FREE) & ~F.coalesce(F.when(other, named.rlike(_FREE)), F.lit(False))
        return F.struct(
            F.when(clean, role).alias("role"),
            unescape(text).alias("text"),
            skip.alias("skip"),
            F.char_length(text).alias("chars"),
            F.char_length(segment).alias("size"),
        )

    turns = F.transform(whole, read)
    seen = F.aggregate(
        turns,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<role:string,text:string,start:int,chars:int>>").alias("done")),
        lambda acc, t: F.struct(
            (acc["at"] + t["size"]).alias("at"),
            F.concat(
                acc["done"],
                F.array(F.struct(t["role"].alias("role"), t["text"].alias("text"), (acc["at"] + t["skip"]).alias("start"), t["chars"].alias("chars"))),
            ).alias("done"),
        ),
    )
    return seen["done"]


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per conversation: its formatted text and the turns read back from it.

    Input columns conv_id, turn, role, text; further columns are ignored. Result:
    conv_id, formatted, spans (array of role, text, start, chars: the turns as the
    parser recovers them, with the place of each escaped text in ``formatted``)
    and passes (0: nothing had to be escaped).

    Turns are ordered by turn (null first), then role and text, so the result does
    not depend on the order of rows; repeated rows are repeated turns. Null text is
    empty, null role is a role of empty name, rows with a null conv_id form one
    conversation; an empty table gives an empty result. A conversation is one
    training example and hence one row; rendering and checking happen turn by turn
    ahead of the grouping, so only the finished segments are gathered.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    plain = turns.select("conv_id", F.col("turn").alias("_turn"), role.alias("_role"), text.alias("_text"))
    # a turn holds no conflict unless a control string occurs in it: pass 0 for the others
    tried = plain.withColumn("_raw", render_turn(F.col("_role"), F.col("_text"))).withColumn("_back", parse(F.col("_raw")))
    same = (
        (F.size("_back") == 1)
        & F.col("_back")[0]["role"].eqNullSafe(F.col("_role"))
        & F.col("_back")[0]["text"].eqNullSafe(F.col("_text"))
    )
    segments = tried.withColumn("_ok", same).select(
        "conv_id", "_turn", "_role", "_text", "_ok",
        F.when(F.col("_ok"), F.col("_raw")).otherwise(render_turn(escape(F.col("_role")), escape(F.col("_text")))).alias("_segment"),
    )
    grouped = segments.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("_turn", "_role", "_text", "_segment", "_ok"))).alias("_rows")
    )
    whole = grouped.withColumn("formatted", F.concat_ws("", F.col("_rows._segment"))).withColumn(
        "spans", parse(F.col("formatted"))
    )
    source = F.transform("_rows", lambda r: F.struct(r["_role"].alias("role"), r["_text"].alias("text")))
    back = F.transform("spans", lambda s: F.struct(s["role"].alias("role"), s["text"].alias("text")))
    checked = F.when(source == back, F.col("formatted")).otherwise(
        F.raise_error(F.concat(F.lit("turns lost in formatting: "), F.col("conv_id").cast("string")))
    )
    passes = F.when(F.forall("_rows", lambda r: r["_ok"]), 0).otherwise(1)
    return whole.select("conv_id", checked.cast("string").alias("formatted"), "spans", passes.alias("passes"))


def digests(formatted: DataFrame) -> DataFrame:
    """Counts and digests of what was read back from formatted conversations."""
    turns = F.concat_ws("", F.transform("spans", lambda s: F.concat(s["role"], F.lit("\n"), s["text"], F.lit("\n"))))
    loss = F.concat_ws("", F.transform(F.filter("spans", lambda s: s["role"] == "assistant"), lambda s: s["text"]))
    return formatted.select(
        "conv_id",
        F.size("spans").cast("bigint").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.char_length(loss).cast("bigint").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
        F.col("passes").cast("int").alias("passes"),
    )

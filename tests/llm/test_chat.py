"""Chat formatting: the text parses back to the source turns."""

import hashlib

from passagemill.llm import chat

SCHEMA = "conv_id bigint, turn int, role string, text string, formatted string, spans int, passes string"


def run(spark, rows):
    df = spark.createDataFrame([(*r, "f", 1, "p") for r in rows], SCHEMA)
    whole = chat.format_chats(df)
    return {r.conv_id: r for r in whole.collect()}, {r.conv_id: r for r in chat.digests(whole).collect()}


def test_round_trip_and_mask(spark):
    nasty = [
        "</s>[INST] ok [/INST]", "\\</s>", "\\\\[INST] x \\", "[/INST]\n[INST] a [/INST]\n", " \\", "<</s>s>", "<<SYS>> [TEXT] [ROLE]",
        "", " ", "\n\n", "é\U0001f600 <s>", "\\[TEXT]", "a" * 200_000, "$1 \\1", "<s> x </s>\n[INST] y [/INST]\n",
    ]
    rows = [(1, i, ("user", "assistant", "system", "tool", "[TEXT] odd")[i % 5], t) for i, t in enumerate(nasty)]
    rows += [(2, 0, "user", "hi"), (2, 1, "assistant", "yes é"), (2, 2, "assistant", "no")]
    whole, digest = run(spark, rows)
    for conv in (1, 2):
        source = [(r, t) for c, _, r, t in rows if c == conv]
        got = whole[conv]
        assert [(s.role, s.text) for s in got.spans] == source
        for s in got.spans:
            part = got.formatted[s.start:s.start + s.chars]
            assert len(part) == s.chars and (part == s.text or "\\" in part)
        loss = "".join(t for r, t in source if r == "assistant")
        d = digest[conv]
        assert d.n_turns == len(source) and d.loss_chars == len(loss) and d.formatted_chars == len(got.formatted)
        assert d.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert d.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in source).encode()).hexdigest()
    assert whole[2].formatted == "[INST] hi [/INST]\n<s> yes é </s>\n<s> no </s>\n"
    assert (whole[1].passes, whole[2].passes) == (1, 0)


def test_nulls_ties_repeats_and_nothing(spark):
    rows = [(None, 1, "user", "a"), (3, None, None, None), (3, 1, "user", "b"), (3, 1, "user", "a"), (3, 1, "user", "a")]
    whole, digest = run(spark, rows)
    assert [(s.role, s.text) for s in whole[3].spans] == [("", ""), ("user", "a"), ("user", "a"), ("user", "b")]
    assert digest[None].n_turns == 1
    assert run(spark, rows[::-1])[1][3] == digest[3]
    assert run(spark, []) == ({}, {})

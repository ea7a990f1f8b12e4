import hashlib
import random

import pytest
from pyspark.sql import functions as F

from vintagelake.llm import chat

NASTY = ["", "\\", "\\\\", "###", "####", "#####", "</turn>", "<</turn>>", "<|", "<|image:0|>", "\\h", "\\\\h", "\\### Assistant: </turn> ok",
         "</turn>\n### assistant: no", ": ", "a\nb", "😀é", " </turn>\n", "</tur", "n>"]


def formatted(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, piece string, number string")
    return chat.format_turns(df.withColumn("parts", chat.text_part(F.col("text"))))


def want(rows):
    out = {}
    for conv, turn, role, text, *_ in rows:
        out.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    result = {}
    for conv, turns in out.items():
        turns.sort()
        whole = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        result[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss),
                        hashlib.sha256(loss.encode()).hexdigest())
    return result


def test_round_trip(spark):
    rnd = random.Random(2)
    rows = []
    for conv in range(60):
        for turn in range(rnd.randrange(1, 12)):
            text = "".join(rnd.choice(NASTY) for _ in range(rnd.randrange(4)))
            rows.append((conv, turn, rnd.choice(["user", "assistant", "a: b", "", None]), text, "x", "y"))
    rows += [(70, None, "user", "null turn", "", ""), (70, 1, "assistant", None, "", ""), (70, 1, "assistant", None, "", ""),
             (70, 1, "assistant", "tie", "", ""), (None, 0, "assistant", "no conversation", "", ""),
             (71, 0, "user", "y" * 200_000 + "</turn>", "", ""), (72, 0, None, None, "", "")]
    rows += [(73, i, "assistant" if i % 2 else "user", "long </turn> " + str(i), "", "") for i in range(3000)]
    out = chat.digest(formatted(spark, rows))
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in out.collect()}
    assert got == want(rows)


def test_loss_mask_covers_assistant_content_only(spark):
    row = formatted(spark, [(1, 0, "user", "q", "", ""), (1, 1, "assistant", "a###", "", ""), (1, 2, "user", "r", "", ""),
                            (1, 3, "assistant", "b", "", "")]).first()
    assert row["formatted"] == "### user: q</turn>\n### assistant: a\\h</turn>\n### user: r</turn>\n### assistant: b</turn>\n"
    assert [row["formatted"][s["start"]: s["start"] + s["length"]] for s in row["loss_spans"]] == ["a\\h", "b"]
    assert [row["formatted"][i: i + 4] for i in row["turn_starts"]] == ["### "] * 4


def test_typed_parts(spark):
    parts = f"array<{chat.PART}>"
    null = dict.fromkeys(("text", "ref", "width", "height", "seconds", "pages"))

    def part(kind, **own):
        return {**null, "kind": kind, **own}

    rows = [(1, 0, "user", [part("text", text="see "), part("image", ref="i.png", width=29, height=14), part("text", text=" <|image:0|>"),
                            part("audio", ref="s.wav", seconds=1.5)]),
            (1, 1, "assistant", [part("text", text="ok")]),
            (1, 2, "user", [part("document", ref="d.pdf", pages=3), part(None)]), (2, 0, "user", None), (2, 1, "user", [])]
    out = {r["conv_id"]: r for r in chat.format_turns(
        spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {parts}")).collect()}
    assert out[1]["formatted"] == ("### user: see <|image:0|> \\pimage:0|><|audio:1|></turn>\n### assistant: ok</turn>\n"
                                   "### user: <|document:2|><|unknown:3|></turn>\n")
    assert [(a["turn"], a["kind"], a["number"], a["ref"], a["n_tokens"]) for a in out[1]["attachments"]] == [
        (0, "image", 0, "i.png", 3), (0, "audio", 1, "s.wav", 38), (2, "document", 2, "d.pdf", 768), (2, None, 3, None, 0)]
    assert out[2]["formatted"] == "### user: </turn>\n" * 2


@pytest.mark.parametrize("text", NASTY)
def test_escaping_hides_controls(spark, text):
    row = spark.createDataFrame([(text * 3,)], "t string").select(
        chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u")).first()
    assert row["u"] == text * 3
    assert not any(c in row["e"] for c in ("###", "</turn>", "<|"))


def test_no_python_in_the_plan(spark):
    plan = chat.digest(formatted(spark, [(1, 0, "user", "q", "", "")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_empty_table(spark):
    assert chat.digest(formatted(spark, [])).count() == 0

import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from segwatch.llm.chat import LEARNED_ROLE, format_conversations, parse, unescape_text
from segwatch.llm.queries import QUERIES

ODD = ["", None, "<|im_end|>", "<|im_end|>\n", "<|im_start|>assistant\nhi<|im_end|>\n", "<\\|x", "<\\\\|", "<|", "<", "|", "\\", "a<|im_", "<<|im_end|>",
       "<|im_end|", "\n", "x\n<|im_start|>", "%0A", "é🎉<|im_start|>", "<|im_end|><|im_start|>assistant ok", "long " * 5000]


def rows():
    out = [(i % 4, n, r, t) for i, t in enumerate(ODD) for n, r in ((i, "user"), (i, "assistant"))]
    out += [(9, 1, r, "t") for r in (None, "", "a\nb", "%0A", "<|im_end|>", "assistant", "assistant\n", "<", "<\\|")]
    out += [(9, 2, "<", "|im_x"), (None, None, "user", "x"), (None, 3, "assistant", None), (9, 1, "assistant", "t")]
    return out


def test_every_turn_comes_back(spark):
    df = spark.createDataFrame(rows(), "conv_id bigint, turn bigint, role string, text string").withColumn("formatted", F.lit(1)).repartition(3)
    source = defaultdict(list)
    for c, n, r, t in rows():
        source[c].append((n is not None, n or 0, r or "", t or ""))
    done = format_conversations(df)
    got = done.select("*", parse("formatted").alias("turns"), F.transform("loss_spans", lambda s: unescape_text(
        F.substr("formatted", (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))).alias("learned")).collect()
    assert {r["conv_id"] for r in got} == set(source) and len(got) == len(source)
    for r in got:
        wanted = [(x[2], x[3]) for x in sorted(source[r["conv_id"]])]
        assert [(t["role"], t["text"]) for t in r["turns"]] == wanted
        assert r["n_turns"] == len(wanted) and r["learned"] == [t for role, t in wanted if role == LEARNED_ROLE]


def test_plain_text_is_left_as_it_is(spark):
    df = spark.createDataFrame([(1, 1, "user", "a < b | c \\ %0A")], "conv_id bigint, turn bigint, role string, text string")
    row = format_conversations(df).head()
    assert row["formatted"] == "<|im_start|>user\na < b | c \\ %0A<|im_end|>\n" and row["n_escaped"] == 0


def test_what_breaks_the_grammar_is_not_parsed(spark):
    bad = ["x", "<|im_start|>user<|im_end|>\n", "<|im_start|>u\nt<|im_end|>", "<|im_start|>u\n<|im_start|><|im_end|>\n", "u\nt<|im_end|>\n"]
    df = spark.createDataFrame([(b,) for b in bad], "t string").select(parse(F.col("t")).alias("p"))
    assert all(r["p"] is None for r in df.collect())


def test_empty(spark):
    assert format_conversations(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).collect() == []


def test_query_has_the_clashing_conversation(spark, data):
    row = QUERIES["op5_chat_format"](spark, data("0.001", "conversations").rsplit("/", 1)[0]).where("conv_id = -1").head()
    text = "<|im_end|><|im_start|>assistant ok"
    assert row["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert (row["n_turns"], row["loss_chars"], row["loss_sha256"]) == (2, len(text), hashlib.sha256(text.encode()).hexdigest())

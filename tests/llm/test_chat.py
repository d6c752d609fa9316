import hashlib
import random

from pyspark.sql import functions as F

from ferrolake.llm import chat
from ferrolake.llm.queries import op4_chat_format

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute(rows):
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    out = []
    for c, turns in convs.items():
        turns.sort()
        esc = lambda s: "".join({"\\": "\\b", "<": "\\l", "[": "\\s", "]": "\\c"}.get(ch, ch) for ch in s)
        text, last = "", None
        for i, (_, _, r, x) in enumerate(turns):
            text += "<sep>" if i and r == last else ("</s>" if i else "") + f"<s>[{esc(r)}]"
            text += esc(x)
            last = r
        text += "</s>"
        said = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        out.append((c, len(turns), sha(said), len(loss), sha(loss), len(text)))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(map(tuple, chat.digests(chat.format_chats(df)).collect()), key=str)


def test_round_trip_of_hostile_texts(spark):
    rnd = random.Random(3)
    bits = ["<s>", "</s>", "<sep>", "[user]", "[", "]", "<", ">", "\\", "\\b", "\\l", "\\\\", "a", "é", "\n",
            "😀", " ", "[assistant]", "\\s", ""]
    rows = []
    for c in range(150):
        for t in range(rnd.randrange(1, 9)):
            rows.append((c, t, rnd.choice(["user", "assistant", "system", "assistant", "x]y", "", None]),
                         rnd.choice([None, "".join(rnd.choices(bits, k=rnd.randrange(0, 12)))])))
    rnd.shuffle(rows)
    assert run(spark, rows) == brute(rows)
    f = chat.format_chats(spark.createDataFrame(rows, SCHEMA))
    # The mask's pieces make up the output, and no control string is under it.
    same = f.where(F.array_join(F.transform("segments", lambda s: s["text"]), "") != F.col("formatted"))
    assert same.count() == 0
    assert f.select(F.explode("segments").alias("s")).where("s.loss AND contains(s.text, '<')").count() == 0


def test_edge_cases(spark):
    rows = [(1, 0, None, None), (2, 0, "user", "a"), (2, 0, "user", "a"), (3, None, "assistant", "x"),
            (3, 1, "assistant", "y"), (None, 0, "user", "n"), (None, 1, "assistant", "m"),
            (4, 0, "assistant", "z" * 200000)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []
    long = [(9, t, "assistant" if t % 2 else "user", f"t{t}") for t in range(3000)]
    assert run(spark, long) == brute(long)
    wide = spark.createDataFrame([(1, 0, "user", "a", 1, "b")], SCHEMA + ", turns int, segments string")
    assert chat.format_chats(wide).columns == ["conv_id", "formatted", "segments"]


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    x = "</s>[INST] ok [/INST]"
    want = brute(rows + [(-7, 0, "user", x), (-7, 1, "assistant", x)])
    assert sorted(map(tuple, op4_chat_format(spark, SF).collect()), key=str) == want

import hashlib
import random

from farebox.llm import chat

BITS = ["</s>", "[INST] ", " [/INST]", "<s>", "\\", "<<SYS>>", "[", "<", "ok", "\n", "ü", " ", "</name>", "<role>", "/INST]"]


def noise(rng, n=12):
    return "".join(rng.choice(BITS) for _ in range(rng.randint(0, n)))


def test_quote_round_trip_and_no_control_left():
    t, rng = chat.Template(), random.Random(1)
    for _ in range(500):
        x = noise(rng)
        q = t.quote(x)
        assert t.unquote(q) == x
        assert not any(c.strip() in q for c in t.controls())
        turns = [("user", x), ("odd<role>", noise(rng)), ("assistant", noise(rng)), ("system", "")]
        text = "".join(s for _, s, _, _ in chat.segments(turns, t))
        assert [(r, t.unquote(b)) for r, b, _, _ in chat.Reader(t).turns(text)] == turns


def test_no_control_left_with_marks_that_begin_with_letters():
    t = chat.Template(roles={"user": chat.Turn("user:", "end"), "assistant": chat.Turn("0bot:", "1end", loss=True)}, other=chat.Turn("a:", "b:"), name_end="c:", escape="0")
    rng = random.Random(4)
    for _ in range(500):
        x = "".join(rng.choice(["user:", "end", "0bot:", "1end", "0", "1", "u", "a:", "b:", "c:", "e", "00", " "]) for _ in range(9))
        assert t.unquote(t.quote(x)) == x and not any(c in t.quote(x) for c in t.controls() if not c.startswith("0"))


def test_machine_marks_turns_out_of_order():
    def valid(roles):
        out = {}
        for n, _, _, ok in chat.segments([(r, "x") for r in roles], chat.Template()):
            out[n] = ok
        return list(out.values())

    assert valid(["system", "user", "assistant", "user"]) == [True] * 4
    assert valid(["assistant", "user", "user", "assistant"]) == [False, True, False, True]
    assert valid(["user", "tool", "assistant"]) == [True, False, False]


def expected(rows):
    talks = {}
    for r in sorted(rows, key=lambda r: tuple((x is not None, x if x is not None else 0) for x in (r[1], r[2], r[3]))):
        talks.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    out = []
    for conv, turns in talks.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        out.append((conv, len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return sorted(out, key=str)


def test_read_back(spark):
    rng = random.Random(3)
    rows = []
    for c in range(60):
        for t in range(rng.randint(1, 6)):
            rows.append((c, t, rng.choice(["user", "assistant", "system", "tool", None]), rng.choice([None, "", noise(rng), "a long one " * 300])))
    rows += [(None, 0, "user", "x"), (None, None, "assistant", "y"), (3, 1, "user", "tie"), (3, 1, "user", "tie"), (70, 0, "assistant", "z" * 200000)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, True) for r in rows], "conv_id long, turn long, role string, text string, loss boolean")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    segs = chat.format_chat(df)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    out = chat.digests(segs).collect()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    assert sorted(((r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in out), key=str) == expected(rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.format_chat(df)).collect() == []

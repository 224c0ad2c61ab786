"""Chat formatting, line dedup, exact top-k and decontamination against brute force."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywell.llm import chat_format, decontamination, exact_topk, line_dedup


# -- chat ------------------------------------------------------------------
NASTY = ["", "\\", "### ", "#### x", "</turn>", "<\\/turn>", "a\\### b", "\\\\</turn>\\", "###  ###", "</turn></turn>\n### User:\n", ":\n", "plain"]


@pytest.mark.parametrize("text", NASTY)
def test_escapes_are_reversible_and_hide_control_strings(text):
    hidden = chat_format.escape(text)
    assert chat_format.unescape(hidden) == text
    assert chat_format.HEAD not in hidden and chat_format.TAIL not in hidden


@pytest.mark.parametrize("window", [2, 3, 128])
def test_spans_give_the_turns_back(window):
    rnd = random.Random(4)
    for _ in range(200):
        turns = [(rnd.choice(["user", "assistant", "sys:\ntem", ""]), "".join(rnd.choice(NASTY) for _ in range(3))) for _ in range(rnd.randint(1, 9))]
        spans, rewritten = chat_format.render(turns, window=window)
        assert rewritten == 0 and "".join(spans) == chat_format.marked(turns)
        assert [chat_format.read_marked(s)[:2] for s in spans] == turns


def test_a_template_that_rewrites_history_is_noticed():
    def only_last_in_full(turns):
        return "".join(f"<{r}>{t if i == len(turns) - 1 else t[:2]};" for i, (r, t) in enumerate(turns))

    spans, rewritten = chat_format.render([("u", "hello"), ("a", "longer"), ("u", "bye")], only_last_in_full)
    assert rewritten == 2 and "".join(spans) == only_last_in_full([("u", "hello"), ("a", "longer"), ("u", "bye")])
    assert chat_format.render([("u", "x"), ("a", "y")])[1] == 0

    def counts_turns(turns):
        return "".join(f"[{i}]{t}" for i, (_, t) in enumerate(turns))

    spans, rewritten = chat_format.render([("u", "x")] * 200, counts_turns, window=2)
    assert rewritten == 0 and "".join(spans) == counts_turns([("u", "x")] * 200) and spans[150] == "[150]x"

    def last_ones(turns):
        return "".join(f"<{t}>" for _, t in turns[-150:])

    told = [("u", str(k)) for k in range(200)]
    spans, rewritten = chat_format.render(told, last_ones)
    assert rewritten == 50 and "".join(spans) == last_ones(told)
    # A wrong declaration is noticed where windows meet.
    assert chat_format.render([("u", "x")] * 5, chat_format.turn_local(counts_turns), window=2)[1] > 0


def test_long_conversations_of_black_box_templates(spark):
    def numbered(turns):
        return "".join(f"[{i}]{r}:{t}\n" for i, (r, t) in enumerate(turns))

    df = spark.createDataFrame([(1, k, "user", f"t{k}") for k in range(300)], "conv_id long, turn long, role string, text string")
    rows = chat_format.format_turns(df.repartition(3), numbered).orderBy("turn").collect()
    assert "".join(r.formatted for r in rows) == numbered([("user", f"t{k}") for k in range(300)]) and rows[-1].rewritten == 0


def test_conversations_equal_plain_digests(spark):
    rnd = random.Random(6)
    rows = [(c, t, rnd.choice(["user", "assistant", None]), rnd.choice([*NASTY, None])) for c in [0, 1, 2, None] for t in range(rnd.randint(1, 7))]
    rows += [(9, t, "assistant" if t % 2 else "user", f"t{t}") for t in range(300)] + [(1, 0, "user", "same"), (1, 0, "user", "same"), (5, None, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("conv", F.lit("clash"))
    got = {r.conv: r for r in chat_format.format_conversations(df.repartition(5)).collect()}
    held = collections.defaultdict(list)
    for c, t, r, x in rows:
        held[c].append(((t is not None, t or 0), r or "", x or ""))
    assert set(got) == set(held)
    for c, turns in held.items():
        turns = [(r, x) for _, r, x in sorted(turns)]
        loss = "".join(x for r, x in turns if r == "assistant")
        assert got[c].n_turns == len(turns) and got[c].rewritten == 0
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[c].formatted_chars == len(chat_format.marked(turns))
    spans = chat_format.format_turns(df).where("conv = 9").orderBy("turn").collect()
    assert "".join(r.formatted for r in spans) == chat_format.marked([(r, x) for c, _, r, x in rows if c == 9])
    assert chat_format.format_conversations(df.limit(0)).count() == 0


# -- line dedup ------------------------------------------------------------
def plain_dedup(docs):
    seen, out = set(), {}
    windows = sorted((i, v, k, tuple(x.split("\n")[k:k + 3])) for v, (i, x) in enumerate(docs) if x is not None for k in range(len(x.split("\n")) - 2))
    gone = collections.defaultdict(set)
    for i, _, k, w in windows:
        if any(line.strip(" ") for line in w):
            if w in seen:
                gone[i] |= {k, k + 1, k + 2}
            seen.add(w)
    for i, x in docs:
        out[i] = (x, 0) if not gone[i] else ("\n".join(line for n, line in enumerate(x.split("\n")) if n not in gone[i]), len(gone[i]))
    return out


def test_line_dedup_equals_plain_loop(spark):
    rnd = random.Random(7)
    docs = [(i, "\n".join(rnd.choice(["a", "b", "", " ", "c"]) for _ in range(rnd.randint(0, 12)))) for i in range(80)]
    docs += [(100, None), (101, ""), (102, "\n\n\n\n"), (103, "x\nx\nx\nx\nx"), (104, "one\ntwo\nthree\nend"), (105, "zero\none\ntwo\nthree")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns(
        {"row": F.lit(1), "lines": F.lit("clash"), "version": F.lit(None).cast("long"), "a`b": F.col("doc_id")})
    done = line_dedup.dedup_lines(df.repartition(6))
    assert done.columns == [*df.columns, "dedup_lines", "dedup_removed"]
    got = {r.doc_id: (r.text, r.dedup_removed) for r in done.collect()}
    assert got == plain_dedup(docs)
    assert got[105] == ("zero", 3) and got[103] == ("x", 4) and got[102] == ("\n\n\n\n", 0)
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_line_dedup_with_repeated_and_null_ids(spark):
    text = "one\ntwo\nthree"
    df = spark.createDataFrame([(1, text), (1, text), (None, "x\n" + text), (2, text)], "doc_id long, text string")
    rows = sorted((r.doc_id or 0, r.text) for r in line_dedup.dedup_lines(df).collect())
    # The null id comes first, the two equal rows share one result.
    assert rows == [(0, "x\n" + text), (1, ""), (1, ""), (2, "")]


def test_line_dedup_plan_is_native(spark):
    plan = line_dedup.dedup_lines(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


# -- exact top-k -----------------------------------------------------------
def plain_topk(vectors, queries, k, scale):
    whole = [(i, np.floor(scale * np.array(v, float)).astype(object)) for i, v in vectors
             if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all()]
    out = []
    for q, a in {i: v for i, v in whole if i in queries}.items():
        scored = [(-sum(int(x) * int(y) for x, y in zip(a, b)), i) for i, b in whole if i != q]
        out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.mark.parametrize("block", [20_000, 3])
def test_topk_equals_brute_force(spark, block):
    rnd = random.Random(8)
    vectors = [(i, [rnd.choice([0.0, 0.001, -0.004, 0.5, rnd.uniform(-1, 1)]) for _ in range(6)]) for i in range(150)]
    vectors += [(i, vectors[i - 200][1]) for i in range(200, 230)]
    vectors += [(300, None), (301, [1.0, None, 1.0]), (302, [float("nan")] * 6), (350, [float("inf")] * 6), (None, [1.0] * 6), (304, []), (305, [1.0, 2.0])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").withColumns({"id": F.lit("clash"), "score": F.lit(1)})
    queries = {i for i, _ in vectors if i is not None and i % 25 == 0}
    found = exact_topk.exact_topk(df.repartition(4), df.where("vec_id % 25 = 0"), 5, 256.0, query_block=block)
    assert sorted((r.query_id, r["rank"], r.id, r.score) for r in found.collect()) == plain_topk(vectors, queries, 5, 256.0)


def test_topk_small_and_large_cases(spark):
    def run(rows):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        return sorted(tuple(r) for r in exact_topk.exact_topk(df, df.where("vec_id = 0"), 5).collect())

    assert run([]) == [] and run([(0, [1.0])]) == []
    assert run([(0, [1.0]), (1, [0.5]), (1, [0.5])]) == [(0, 1, 1, 32768), (0, 2, 1, 32768)]
    assert run([(0, [1e30]), (1, [1e30]), (2, [-1e30])]) == [(0, 1, 1, 2**63 - 1), (0, 2, 2, -2**63)]
    sparse = exact_topk.accumulate(np.array([[0, 0, 3], [1, 0, 0]]), np.array([[0, 5, 1], [2, 0, 0], [0, 0, 0]]))
    assert sparse.tolist() == [[3, 0, 0], [0, 2, 0]]


def test_repeated_query_ids_and_blocks(spark):
    rnd = np.random.default_rng(11)
    rows = [(i % 37, [float(x) for x in rnd.integers(-9, 9, 5)]) for i in range(90)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = []
    for q in {i for i, _ in rows if i % 5 == 0}:
        told = sorted((-sum(int(a) * int(b) for a, b in zip(v, w)), c) for i, v in rows if i == q for c, w in rows if c != q)[:4]
        want += [(q, n, c, -s) for n, (s, c) in enumerate(told, 1)]
    for block in (1000, 4):
        got = exact_topk.exact_topk(df.repartition(3), df.where("vec_id % 5 = 0"), k=4, scale=1.0, query_block=block).collect()
        assert sorted((r.query_id, r.rank, r.id, r.score) for r in got) == sorted(want)


# -- decontamination -------------------------------------------------------
def make_items(n=40, seed=9):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 6))) for _ in range(300)] + ["the", "of", "and"] * 40
    text = lambda k: " ".join(rnd.choice(vocabulary) for _ in range(k))
    return [(i, f"{text(rnd.randint(8, 30))}. {text(rnd.randint(4, 10))}.") for i in range(n)], text, rnd


def test_wand_retrieves_what_full_scoring_does():
    items, _, rnd = make_items()
    parts = [decontamination.split_item(t) for _, t in items]
    frequency = collections.Counter(w for q, a in parts for w in set(q + a))
    index = decontamination.ItemIndex(parts, frequency, len(parts), sum(len(q + a) for q, a in parts) / len(parts), 0.3)
    for _ in range(300):
        q, a = rnd.choice(parts)
        terms = sorted({index.term[w] for w in q + a if rnd.random() < 0.6} | set(rnd.sample(range(1, len(index.lists)), 20)))
        scores = collections.defaultdict(float)
        for t in terms:
            for d, w in zip(*index.lists[t]):
                scores[d] += w
        assert {d for d, _ in index.retrieve(terms)} == {d for d, s in scores.items() if s >= 0.3 - 1e-9}


@pytest.mark.parametrize("block", [20_000, 7])
def test_leaks_are_found_and_clean_documents_stay(spark, block):
    items, text, rnd = make_items()
    docs = [(i, text(rnd.randint(0, 400))) for i in range(60)]
    planted = set()
    for i in range(60, 100):
        k = rnd.randrange(len(items))
        docs.append((i, f"{text(rnd.randint(0, 200))}\n{items[k][1].upper()}\n{text(rnd.randint(0, 200))}"))
        planted.add((i, k))
    question, answer = decontamination.split_item(items[0][1])
    docs += [(200, " ".join(question) + " " + text(50)), (201, " ".join(answer) + " " + text(50)), (202, None), (203, ""), (None, items[3][1])]
    planted.add((None, 3))
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"item": F.lit("clash"), "id": F.lit(0)})
    held = spark.createDataFrame([*items, (500, None), (501, ""), (502, "...")], "item_id long, text string").withColumn("question", F.lit(1))
    found = {(r.id, r.item) for r in decontamination.find_leaks(df.repartition(3), held, block=block).collect()}
    assert found == planted
    kept = decontamination.drop_leaked(df, held, block=block)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i, _ in docs} - {i for i, _ in planted}


def test_decontamination_without_items_or_documents(spark):
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.find_leaks(docs, items).count() == 0 and decontamination.drop_leaked(docs, items).count() == 1
    one = spark.createDataFrame([(1, "some text here now")], "item_id long, text string")
    assert decontamination.find_leaks(docs.limit(0), one).count() == 0

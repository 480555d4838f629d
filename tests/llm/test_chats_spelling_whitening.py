"""Chat formatting, spelling variants and whitening against brute force, on odd rows and on the driver's small tables."""

from __future__ import annotations

import hashlib
import json
import re
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cauce.llm import chat_format, spelling, whitening
from cauce.llm.common import table

TABLES = "/root/testdata/sf0.001"
CONTROLS = ["\\### Assistant: </turn> ok", "", "#", "##", "###\\", "</turn>\n### user:\nx", "\\</turn>", "<\\/turn>", "</turn", "a:\n", "\\\\n", "é\u0301 日本\r\n"]


# ---- chats

def brute_digests(turns):
    said, loss, n = hashlib.sha256(), hashlib.sha256(), 0
    for role, text in turns:
        said.update(f"{role}\n{text}\n".encode())
        if role == "assistant":
            loss.update(text.encode())
            n += len(text)
    return len(turns), said.hexdigest(), n, loss.hexdigest()


def read_back(spark, records, folder, **more):
    chat_format.write_formatted(records, folder, **more)
    pieces = spark.read.schema(chat_format.PIECES).parquet(folder)
    return {(r.conv_id, r.record >= 0): (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat_format.digests(pieces).collect()}


def test_turns_come_back_from_the_text():
    for role in [*CONTROLS, "user", "a:", "a:\nb:\n"]:
        for text in CONTROLS:
            whole, start, length = chat_format.formatted(role, text)
            assert list(chat_format.parsed(whole * 2)) == [(role, text)] * 2
            assert chat_format.unescaped(whole[start:start + length]) == text
            assert whole.count("</turn>") == 1 and "##" not in whole[start:start + length]


@pytest.mark.parametrize("piece", [40, 1 << 16])
def test_rows_by_turn(spark, tmp_path, monkeypatch, piece):
    monkeypatch.setattr(chat_format, "PIECE", piece)
    rows = [(1, 2, "assistant", CONTROLS[0], "x"), (1, 1, "user", "hi", "x"), (2, 0, "assistant", None, "x"), (2, 0, None, "no role", None),
            (None, None, "user", "lost", None), (None, 5, "user", "lost", ""), (3, 1, "assistant", "twice", ""), (3, 1, "assistant", "twice", ""),
            (4, -1, "user", "w " * 50_000, ""), (4, 10_000, "assistant", "y" * 100_000, "")]
    rows += [(5, k, "assistant" if k % 2 else "user", CONTROLS[k % len(CONTROLS)], "") for k in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, prompt string")
    want = defaultdict(list)
    for conv, turn, role, text, _ in sorted(rows, key=lambda r: (r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want[conv if conv is None else str(conv), False].append((role or "", text or ""))
    got = read_back(spark, chat_format.records_of_rows(df), str(tmp_path / "chats"))
    assert got == {k: brute_digests(v) for k, v in want.items()}


def test_layouts_are_chosen_by_their_paths(spark, tmp_path):
    records = [
        {"conv_id": 1, "turn": 0, "role": "user", "text": "a", "extra": {"deep": [1]}}, {"text": "b", "role": "assistant", "turn": 1, "conv_id": 1},
        {"id": "m", "messages": [{"role": "system", "content": "s"}, {"content": "q", "role": "human", "name": "x"}, {"role": "assistant", "content": None}]},
        {"id": 7, "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"id": 8, "system": "s", "conversations": [{"from": "gpt", "value": "a"}]},
        {"meta": {"id": "d"}, "dialog": {"turns": [{"speaker": "bot", "utterance": "a"}]}},
        {"id": "i", "instruction": "q", "input": "", "output": "a"}, {"id": "j", "instruction": "q", "output": "a", "prompt": None},
        {"id": "p", "prompt": "q", "completion": "a"}, {"id": "n", "question": "q", "answer": 5},
        {"id": "none", "what": 1}, {"id": "empty", "messages": []}, [1, 2], {"id": "odd`, x: y<z>", "messages": "no list"}]
    df = spark.createDataFrame([(json.dumps(r),) for r in records] + [("{not json",), (None,)], "value string")
    df = chat_format.records_of_json(df)
    got = read_back(spark, df, str(tmp_path / "chats"))
    u, a, s = (lambda t: ("user", t)), (lambda t: ("assistant", t)), (lambda t: ("system", t))
    want = {("1", False): [u("a"), a("b")], ("m", True): [s("s"), u("q"), a("")], ("7", True): [u("q"), a("a")], ("8", True): [s("s"), a("a")],
            ("d", True): [a("a")], ("i", True): [u("q"), u(""), a("a")], ("j", True): [u("q"), a("a")], ("p", True): [u("q"), a("a")],
            ("n", True): [u("q"), a("5")]}
    assert got == {k: brute_digests(v) for k, v in want.items()}
    assert sum(r.n for r in chat_format.unmapped(df).collect()) == 6
    prints = [r.fingerprint for r in chat_format.fingerprinted(df).collect()]
    assert prints[0] == prints[1] and len(set(prints[2:10])) == 8
    assert chat_format.canonical_turns(chat_format.records_of_rows(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0


def test_field_paths():
    schema = "OBJECT<`a b`: OBJECT<`c.d`: ARRAY<ARRAY<BIGINT>>, e: VOID>, `f``<`: DECIMAL(3,1), g: ARRAY<OBJECT<h: STRING, i: ARRAY<VOID>>>, j: OBJECT<>>"
    assert chat_format.field_paths(schema) == {"a b.c.d[][]", "a b.e", "f`<", "g[].h", "g[].i[]"}
    assert chat_format.field_paths("ARRAY<BIGINT>") == {"[]"} and chat_format.field_paths("") == frozenset()


def test_conversations_query(spark):
    rows = table(spark, TABLES, "conversations").orderBy("conv_id", "turn").collect()
    want = defaultdict(list, {-7: [("user", CONTROLS[0]), ("assistant", CONTROLS[0])]})
    for r in rows:
        want[r.conv_id].append((r.role, r.text or ""))
    got = chat_format.op11_chat_format(spark, TABLES).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == {k: brute_digests(v) for k, v in want.items()}
    assert {r.conv_id: r.formatted_chars for r in got} == {k: sum(len(chat_format.formatted(*t)[0]) for t in v) for k, v in want.items()}


# ---- spelling

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute_words(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", (text or "").translate(LOWER)):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def brute_groups(n, ratio=10):
    near = defaultdict(set)
    gaps = defaultdict(set)
    for w in n:
        for i in range(len(w)):
            gaps[w[:i], w[i + 1:]].add(w)
            if w[:i] + w[i + 1:] in n:
                near[w].add(w[:i] + w[i + 1:])
                near[w[:i] + w[i + 1:]].add(w)
    for group in gaps.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return {w: (form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def rows_of(df):
    got = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len({r[0] for r in got}) == len(got)
    return {r[0]: r[1:] for r in got}


def test_spelling_query(spark):
    rows = [tuple(r) for r in table(spark, TABLES, "documents").select("doc_id", "text").collect()]
    want = brute_groups(brute_words(rows))
    assert rows_of(spelling.op12_spelling_variants(spark, TABLES)) == want
    assert sum(v[0] is not None for v in want.values()) >= 10


def test_spelling_groups(spark):
    rng = np.random.default_rng(5)
    n = {"".join(rng.choice(list("aab\u00e9\u00ff"), rng.integers(1, 7))): int(10 ** rng.integers(0, 7)) for _ in range(900)}
    n |= {"aaaa": 3, "aaa": 3, "aaaaa": 30, "x": 1, "é": 1, "": 5}
    got = rows_of(spelling.spelling_groups(spark.createDataFrame(list(n.items()), "word string, n int")))
    assert got == brute_groups(n) and max(len(v[1]) for v in got.values()) <= 6
    chain = {"a" * k: 10 ** (15 - k) for k in range(1, 16)}  # fifteen forms in a row
    got = rows_of(spelling.spelling_groups(spark.createDataFrame(list(chain.items()), "word string, n long")))
    assert got == brute_groups(chain) and {v[1] for v in got.values()} == {"a"}
    assert spelling.spelling_groups(spark.createDataFrame([], "word string, n long")).count() == 0


def test_spelling_odd_rows(spark):
    long = " ".join(f"wordword{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(30_000)) + " " + "z" * 20_000 + " " + "z" * 20_000
    rows = [(1, None, "x"), (2, "", ""), (3, long, None), (3, "ÉTÉétéété×÷ ÀÿÀÿÀÿÀ àÿàÿàÿà", ""), (None, "wordwordaa WordWordAA wordwordab", ""),
            (4, "no-long-words 1234567", ""), (3, "ÉTÉétéété×÷ ÀÿÀÿÀÿÀ àÿàÿàÿà", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string")
    got = rows_of(spelling.spelling_groups(spelling.counted(spelling.planted(spelling.runs(docs, shortest=7)))).where("length(word) < 100"))
    words = brute_words([r[:2] for r in rows])
    assert got == {w: v for w, v in brute_groups({w: k for w, k in words.items() if len(w) < 100}).items()}
    assert spelling.runs(docs.limit(0)).count() == 0


def test_spelling_long_words(spark):
    base = "".join(np.random.default_rng(2).choice(list("abcdé"), 60_000))
    words = {base: 50, base[:30_000] + "z" + base[30_001:]: 5, base[:100] + base[101:]: 4, base + "z": 3, base[:-1] + "zz": 2, "x" * 60_000: 2}
    edge = {"y" * 255: 40, "y" * 256: 4, "y" * 257: 30, "y" * 256 + "x": 2, "y" * 258: 2}  # both sides of LONG
    got = rows_of(spelling.spelling_groups(spark.createDataFrame(list((words | edge).items()), "word string, n long")))
    assert {w: got[w] for w in edge} == brute_groups(edge)
    near = [3, 1, 1, 2, 1, 0]
    assert [got[w][3] for w in words] == near and [got[w][0] == base for w in words] == [False, True, True, True, False, False]

    monkey = {"".join(np.random.default_rng(k).choice(list("ab"), 5 + k % 3)): k + 1 for k in range(200)}
    found = spelling._near_long.__globals__
    kept, found["LONG"] = found["LONG"], 3  # all pairs by hashes
    try:
        assert rows_of(spelling.spelling_groups(spark.createDataFrame(list(monkey.items()), "word string, n long"))) == brute_groups(monkey)
    finally:
        found["LONG"] = kept


# ---- whitening

def test_scatter_is_exact():
    rng = np.random.default_rng(0)
    for x in (rng.integers(-5, 300, (1000, 7)), rng.integers(-(1 << 62), 1 << 62, (70, 5)), np.full((3, 2), 7), rng.integers(0, 2, (64, 1))):
        n, sums, cross = whitening.scatter(x.astype(np.int64))
        big = x.astype(object)
        assert n == len(x) and sums == list(big.sum(0)) and (cross == big.T @ big).all()


def test_whitening(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK", 100)
    source = table(spark, TABLES, "embeddings")
    data = source.toPandas()
    x = np.floor(64 * np.stack(data.embedding).astype(float)).astype(int).astype(object) + 1_000_000
    n, sums = len(x), x.sum(0)
    apart = n * x - sums
    cov = (apart.T @ apart / n ** 3).astype(float)
    want = dict(zip(data.vec_id, (apart ** 2).sum(1)))
    got = whitening.op13_whitening(spark, TABLES).toPandas()
    assert len(got) == 32 * n and set(got.n) == {n} and set(got.component) == set(range(1, 33))
    assert all(want[r.vec_id] == r.deviation for r in got.itertuples())
    z = got.pivot(index="vec_id", columns="component", values="whitened").loc[data.vec_id].to_numpy()
    values = np.linalg.eigvalsh(cov)[::-1]
    assert np.allclose(got.groupby("component").explained.first(), values[:32] / np.trace(cov), rtol=1e-9)
    assert np.abs(z.T @ z / n - np.eye(32)).max() < 1e-9 and got.identity_error.max() < 1e-9
    directions = (apart / n).astype(float).T @ z / n / np.sqrt(values[:32])  # of whitened rows: unit vectors, eigenvectors of cov
    assert np.allclose((directions ** 2).sum(0), 1) and np.allclose(cov @ directions, directions * values[:32], atol=1e-9 * values[0])
    assert np.allclose((apart / n).astype(float) @ directions / np.sqrt(values[:32]), z, atol=1e-8)


def test_whitening_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [0.0, 1.0]), (1, [0.0, 1.0]), (None, [1.0, -1.0]), (2, [3e38, 0.5]), (3, None), (4, []), (5, [1.0, None]), (6, [nan, 1.0]),
            (7, [1.0, -inf]), (8, [1.0]), (9, [2.0, 2.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, deviation string")
    out, model, error = whitening.whiten(df)
    got = out.collect()
    assert sorted(str(r.vec_id) for r in got) == ["1", "1", "2", "9", "None"] and model.n == 5 and error < 1e-4
    assert len({len(r.z) for r in got}) == 1 and [r.deviation for r in got if r.vec_id == 2] == [None]
    same = df.where("vec_id = 1")
    out, model, _ = whitening.whiten(same)
    assert out.count() == 0 and model.n == 2 and len(model.values) == 0  # nothing varies
    out, model, _ = whitening.whiten(same.unionByName(df.where("vec_id = 9")))
    assert [len(r.z) for r in out.collect()] == [1] * 3  # one direction varies
    out, model, error = whitening.whiten(df.limit(0))
    assert out.count() == 0 and model is None


def test_whitening_does_not_depend_on_partitions(spark):
    source = table(spark, TABLES, "embeddings")
    a = whitening.exact_scatter(source.repartition(1), 64)
    b = whitening.exact_scatter(source.repartition(7).withColumn("embedding", F.col("embedding").cast("array<double>")), 64)
    assert a[0] == b[0] and a[1] == b[1] and (a[2] == b[2]).all()

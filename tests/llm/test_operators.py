"""Every operator on one small table of odd rows, against plain Python."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from corpuslens.llm import binary, encoding, language_model, lines, minhash, nearest, packing, passages, pii, quality
from corpuslens.llm.tables import exact
from corpuslens.session import ship_package

public_tokenizers = pytest.importorskip("public_tokenizers")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PASSAGE = " ".join(f"passage{i}" for i in range(60))
LONG = " ".join(f"w{(i * 7919) % 100003}" for i in range(6000))
TEXTS = [
    None, "", " \n\t", "one two", "one two", "same line\nOther 1\n SAME line ", "same line\nOther 2", "no\xa0break spaces\x1c <|endoftext|> x",
    "a head of its own here " + PASSAGE + " and then some", "quite another start " + PASSAGE, LONG, LONG + " changed", LONG,
    "mail a@b.co from 10.0.0.1 card 4111 1111 1111 1111 tel +1 (555) 010-9999 é", "in in in in in in in in " * 4,
] + [f"plain text number {i} with a few words of its own kind, {i * i} and more after that." for i in range(6)]


@pytest.fixture(scope="module")
def docs(spark):
    ship_package(spark)
    rows = [(i, t, None if i == 3 else "en", "s", 7, "x") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_lines long, TEXT string")


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_lines(spark, docs, none):
    got = by_id(lines.dedup_lines(docs, min_docs=2))
    keys = [[x.strip(" \t\n\v\f\r").lower() for x in (t or "").split("\n")] for t in TEXTS]
    found = Counter(k for ks in keys for k in set(ks) if k)
    for i, t in enumerate(TEXTS):
        kept = [x for x, k in zip((t or "").split("\n"), keys[i], strict=True) if not found[k] >= 2]
        assert got[i]["text"] == "\n".join(kept)
        assert (got[i]["n_lines"], got[i]["n_dropped"]) == (len(keys[i]), len(keys[i]) - len(kept))
    assert lines.dedup_lines(none).count() == 0


def test_runs_over_many_batches(spark, docs):
    keyed = spark.range(60).selectExpr("id % 5 AS batch", "array(named_struct('h', id % 7, 'g', cast(id % 7 as int))) AS keys")
    runs = lines.known_keys(spark, keyed, 2, batches=5)
    assert len(runs.levels) == 3
    assert {r["h"]: r["n"] for r in runs.all().collect()} == Counter(i % 7 for i in range(60))
    runs.forget()


def test_quality_counts(docs, none):
    got = by_id(quality.quality_rules(docs))
    for i, t in enumerate(TEXTS):
        w = WORD.findall(t or "")
        runs = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        repeat = {k + j for k in range(len(w) - 7) if runs[tuple(w[k : k + 8])] > 1 for j in range(8)}
        full = [x for x in (t or "").split("\n") if WORD.search(x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(full) - len(set(full)), len(repeat))
        assert tuple(got[i][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want
        assert got[i]["base_failed"] == (len(w) < 20 or 100 * len(repeat) > 30 * len(w))
    assert not got[0]["kept"] and got[10]["kept"]
    assert quality.quality_rules(none).count() == 0


def test_robust_estimate_rejects_a_fifth(spark):
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdefghij"), rng.integers(2, 9)))
    rows = [(i, " ".join(word() + ("$$$" if i < 20 else "") for _ in range(80)), "en", "s") for i in range(100)]
    got = by_id(quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")))
    assert [i for i in got if not got[i]["kept"]] == list(range(20))


def test_near_duplicates(docs, none):
    got = {i: r["class_id"] for i, r in by_id(minhash.near_duplicates(docs)).items()}
    assert {i: c for i, c in got.items() if c != i} == {4: 3, 9: 8, 11: 10, 12: 10}
    assert minhash.near_duplicates(none).count() == 0


def test_signatures_estimate_weighted_jaccard():
    rng, seen = np.random.default_rng(5), []
    for _ in range(60):
        v = rng.integers(1, 2**63, 200).astype(np.uint64)
        a = rng.integers(0, 7, 200)
        b = np.where(rng.random(200) < 0.6, a, rng.integers(0, 12, 200))
        s = minhash.signatures(np.concatenate([v[a > 0], v[b > 0]]), np.concatenate([a[a > 0], b[b > 0]]), np.repeat([0, 1], [(a > 0).sum(), (b > 0).sum()]), 2)
        seen.append((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(seen)) < 0.02


def test_passages(docs, none):
    links, copies = passages.repeated_passages(docs)
    got = {(r["a"], r["b"]): r for r in links.collect()}
    assert (8, 9) in got and (10, 11) in got and set(got) <= {(8, 9), (10, 11)}
    r = got[8, 9]
    assert TEXTS[8].split()[r["a_start"] : r["a_stop"]] == PASSAGE.split() == TEXTS[9].split()[r["b_start"] : r["b_stop"]]
    assert [tuple(x) for x in copies.collect()] == [(12, 10)]
    assert all(x.count() == 0 for x in passages.repeated_passages(none))


def test_compact_windows_are_tree_nodes():
    rng = np.random.default_rng(0)
    for _ in range(30):
        line = np.concatenate([[0], rng.integers(1, 500, 90), [0], rng.integers(1, 500, 40), [0]]).astype(np.uint64)
        want = set()
        for i in np.flatnonzero(line):
            low = high = i
            while line[low - 1] >= line[i]:
                low -= 1
            while line[high + 1] >= line[i]:
                high += 1
            if high - low + 1 >= 6:
                want.add((low, i, high))
        assert set(zip(*(x.tolist() for x in passages.compact_windows(line, 6)), strict=True)) == want


PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m.group())
            total = sum(int(c) * (1 + i % 2) - 9 * (i % 2 and int(c) > 4) for i, c in enumerate(reversed(d)))
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else True,
                  "card": 13 <= len(d) <= 19 and total % 10 == 0, "phone": 9 <= len(d) <= 15}[kind]
            out += [(kind, m.start(), m.end())] if ok else []
    return out


def test_pii(spark, docs, none):
    hard = ["a@b.c_d@e.f x@y.z", "1.2.3.4.5.6.7.8 999.1.1.1 0001.2.3.4", "4111 1111 1111 1111, 4111-1111-1111-1111 41111111111111111", "5 -3 - 4111111111111111-",
            "1 " * 9000, "9" * 9000, "a" * 9000 + "@" + "b." * 4000 + "c", "call me: (555) 123-4567", "on 2020-01-02, 1000 2000 3000, 10:20:30", None]
    table = spark.createDataFrame(list(enumerate(hard)), "doc_id long, text string").unionByName(exact(docs, "doc_id", "text").selectExpr("doc_id + 100 AS doc_id", "text"))
    model = pii.SpanModel(spark)
    got = by_id(pii.find_spans(table, model))
    for i, t in [*enumerate(hard), *((k + 100, t) for k, t in enumerate(TEXTS))]:
        assert [(pii.KINDS[s["kind"]], s["start"], s["stop"]) for s in got[i]["base"]] == plain_spans(t or ""), i
    added = [i for i in got if len(got[i]["spans"]) > len(got[i]["base"])]
    assert added == [7]
    clean = by_id(pii.redact(docs, model))
    assert clean[13]["text"] == "mail [EMAIL] from [IP] card [CARD] tel [PHONE] é" and clean[0]["text"] is None
    assert pii.find_spans(none, model).count() == 0


def test_encoder_equals_library():
    from tokenizers import Tokenizer

    for name, spaced in (("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)):
        path = public_tokenizers.path(name)
        texts = [t or "" for t in TEXTS] + ["Größe  und\n\n Maß, d'été 12 345", "a \xa0  b", "I'M  it's\t\tx  <|endoftext|>", "\n\n", "ＡＢ　ｃ ﬁ Ǆ İ"]
        ids, at = encoding.encoder(path, spaced).encode(texts)
        want = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == want


def test_packing(docs, none):
    rows = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=256).toPandas().sort_values(["sequence_id", "offset"])
    ends = rows.groupby("sequence_id")["length"].cumsum()
    assert (ends - rows["length"] == rows["offset"]).all() and ends.max() <= 256
    for _, part in rows.sort_values("start").groupby("doc_id"):
        whole = np.frombuffer(b"".join(part["ids"]), "<u4")
        assert len(whole) == part["doc_tokens"].iloc[0] and whole[-1] == packing.END_ID
        assert (part["start"].to_numpy() == np.cumsum(part["length"].to_numpy()) - part["length"].to_numpy()).all()
    assert set(rows["doc_id"]) == set(range(len(TEXTS)))
    assert packing.pack_documents(none, public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_patterns_fill_packs():
    rng = np.random.default_rng(1)
    histogram = {int(n): int(c) for n, c in zip(range(1, 100), rng.integers(0, 50, 99), strict=True) if c}
    patterns = packing.packing_patterns(histogram, 100)
    used = Counter()
    for copies, pattern in patterns:
        assert sum(n * k for n, k in pattern.items()) <= 100
        for n, k in pattern.items():
            used[n] += copies * k
    assert used == histogram
    assert packing.packing_patterns({10: 25}, 100) == [(2, {10: 10}), (1, {10: 5})]


def test_token_files(spark, docs, none, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    binary.write_tokens(docs, str(tmp_path / "a"), path)
    got, start, tokenizer = by_id(binary.read_tokens(spark, str(tmp_path / "a"))), 0, Tokenizer.from_file(path)
    for i, t in enumerate(TEXTS):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        assert (got[i]["start"], got[i]["n_tokens"], bytes(got[i]["ids"])) == (start, len(ids), ids.tobytes())
        start += len(ids)
    binary.write_tokens(none, str(tmp_path / "b"), path)
    assert binary.read_tokens(spark, str(tmp_path / "b")).count() == 0


def test_token_files_with_missing_and_repeated_ids(spark, docs, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = [(None, "b"), (3, None), ("x1", "a"), ("7", "c d"), ("3", "e")] + [("5", "same")] * 200 + [("5", f"other {i}") for i in range(50)]
    table = spark.createDataFrame([(None if i is None else str(i), t) for i, t in rows], "doc_id string, text string").repartition(4)
    previous = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        binary.write_tokens(table.coalesce(1), str(tmp_path / "a"), path)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", previous)
    got = sorted(binary.read_tokens(spark, str(tmp_path / "a")).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, None, 3, 3, *[5] * 250, 7]
    assert [r["start"] for r in got] == np.cumsum([0, *(r["n_tokens"] for r in got)])[:-1].tolist()
    encode = encoding.encoder(path, True).encode
    ids = lambda t: np.append(encode([t or ""])[0], 0).astype("<u4").tobytes()
    assert Counter(bytes(r["ids"]) for r in got) == Counter(ids(t) for _, t in rows)
    shards = spark.read.parquet(str(tmp_path / "a")).where("first_doc = 5").select("shard").distinct().count()
    assert shards > 3


def test_blocks_hold_any_ids():
    rng = np.random.default_rng(2)
    for n in (0, 1, 127, 128, 129, 5000):
        ids = np.where(rng.random(n) < 0.05, rng.integers(0, 2**32, n), rng.integers(70, 90, n)).astype(np.uint32)
        image = binary.encode_segment(np.array([4]), np.array([n]), ids)
        assert (binary.read_blocks(image) == ids).all()
        assert (binary.read_blocks(image, 1, 3) == ids[128:384]).all()


def test_language_model(docs, none):
    got = by_id(language_model.score_documents(docs))
    tokens = [[*WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t or "")), "\n"] for t in TEXTS]
    held = [zlib.crc32(str(i).encode()) % 10 == 0 for i in range(len(TEXTS))]
    count = Counter(w for i, ws in enumerate(tokens) if not held[i] for w in ws)
    n, v = sum(count.values()), len(count)
    for i, ws in enumerate(tokens):
        base = sum(np.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        assert got[i]["held_out"] == held[i] and got[i]["n_tokens"] == len(ws) and got[i]["train_tokens"] == n
        assert got[i]["n_known"] == sum(count[w] > 0 for w in ws) and got[i]["base_score"] == pytest.approx(base)
        assert got[i]["score"] < 0
    assert language_model.score_documents(none).count() == 0


def test_predictions_sum_to_one():
    totals = object.__new__(language_model._Totals)
    totals.customers, totals.tables = np.zeros(256), np.zeros(256)
    seats = object.__new__(language_model._Seats)
    seats.word, seats.context = np.array([0, 1, 1, 2, 3]), np.array([0, 0, 1, 0, 0])
    seats.count, seats.tables = np.array([5, 2, 1, 1, 0]), np.array([2, 1, 1, 1, 0])
    seats.words = np.arange(4)
    np.add.at(totals.customers, seats.context, seats.count)
    np.add.at(totals.tables, seats.context, seats.tables)
    totals.discount, totals.parent_discount, totals.known, totals.tokens = 0.6, 0.4, 3, 9
    assert totals.probability(seats)[seats.context == 0].sum() == pytest.approx(1)


def test_top_k(spark, none):
    rng = np.random.default_rng(4)
    vectors = [(i, rng.normal(size=6).tolist()) for i in range(300)]
    vectors += [(300, vectors[7][1]), (301, None), (302, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (303, [float("nan")] * 6), (None, [1.0] * 6), (304, [1e9] * 6)]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = nearest.top_k(table, table.where("vec_id % 50 = 0")).collect()
    ok = {i: [int(np.floor(256 * c)) for c in x] for i, x in vectors if i is not None and x and None not in x and np.isfinite(x).all()}
    want = []
    for q in [i for i in ok if i % 50 == 0]:
        scores = sorted((-sum(a * b for a, b in zip(ok[q], x, strict=True)), i) for i, x in ok.items() if i != q)[:5]
        want += [(q, r, i, -s) for r, (s, i) in enumerate(scores, 1)]
    assert sorted(map(tuple, got)) == sorted(want)
    empty = table.limit(0)
    assert nearest.top_k(empty, empty).count() == 0



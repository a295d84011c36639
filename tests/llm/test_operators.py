"""Each operator against a brute-force version or the library it must agree with."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

pytest.importorskip("pathkin.llm")

import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

from pathkin.llm import bpe, components, hmm, huffman, jaccard, licenses, mtree, packing, quality, secret_scan, tokens, toxicity
from pathkin.llm.queries import BYTE_BPE, RANKS

KEY = "7602ad27cf5550de1c9b"
RANDOM = "Xk29fQz7LmT4vB8nRw3HsY6cJd1PgE5aUo0iKtVbWq"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed: int, n: int) -> str:
    return " ".join(np.random.default_rng(seed).choice(WORDS, n))


TEXTS = {
    0: prose(0, 80),
    1: prose(0, 80),
    2: prose(0, 79) + " changed",
    3: None,
    4: "",
    5: f'token = "{KEY}" and PASSWORD:{KEY} AKIAABCDEFGHIJKL000 {"0af3" * 10}',
    6: "Licensed under CC BY-NC 4.0.\nAll rights reserved. GNU General Public License",
    7: "word " * 60,
    8: "a  b\n\n c <|endoftext|> 日本 é" + " \n" * 3,
    9: prose(9, 3000) + " " + RANDOM,
    10: " ".join(f"unique{k}" for k in range(70)) + "\nline one\nline one\n#$%",
    None: prose(11, 60),
}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s" if i != 6 else None, "x", 1.0, "k") for i, t in TEXTS.items()]
    rows.append((2, TEXTS[2], "en", "s", "x", 1.0, "k"))  # a repeated row
    # Extra columns named like results.
    schema = "doc_id long, text string, lang string, source string, n_words string, score double, key string"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def by_id(df, *columns):
    return sorted(((r["doc_id"], *(r[c] for c in columns)) for r in df.collect()), key=repr)


def expected(of):
    rows = [(i, *of(t or "")) for i, t in TEXTS.items()]
    rows.append((2, *of(TEXTS[2])))
    return sorted(rows, key=repr)


# 1


def brute_base(text):
    found = [
        (m.start(), 0, m.end())
        for m in re.finditer(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text, re.I | re.A)
        if len(m[2]) >= 8
    ]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def test_base_secrets(docs, empty):
    got = secret_scan.find_secrets(docs)
    assert by_id(got.select("doc_id", secret_scan.listed("base").alias("b")), "b") == expected(
        lambda t: (",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in brute_base(t)),)
    )
    assert secret_scan.find_secrets(empty).count() == 0


def test_battery_tells_random_strings_from_words():
    noise = np.random.default_rng(1)
    random = [secret_scan.score("".join(noise.choice(list("0123456789abcdef"), 40))) for _ in range(300)]
    assert 0.3 < np.median(random) < 0.7  # near uniform for random strings
    assert np.mean(np.array(random) < 0.01) < 0.05
    words = [secret_scan.score(prose(k, 20).replace(" ", "")[:48]) for k in range(100)]
    assert np.median(words) < 1e-3


def test_false_share_bounds_the_choice():
    found, plain = np.zeros((7, 64), np.int64), np.zeros((7, 64), np.int64)
    plain[4, 30:40] = 1000
    found[4, 1], found[4, 35] = 50, 50
    cells = secret_scan.choose_cells(found, plain, 0.01)
    assert 4 * 64 + 1 in cells and 4 * 64 + 35 not in cells
    assert not secret_scan.choose_cells(found * 0, plain, 0.01)


def test_null_distribution_counts_every_plain_run(spark):
    """Letters before the middle and after the first 96 count like all others."""
    noise = random.Random(5)
    texts = [" ".join("".join(noise.choices("abcdefghijklmnopqrstuvwxyz", [1 + k % 7 for k in range(26)], k=noise.randint(1, 9)))
             for _ in range(noise.randint(0, 400))) + " Ünd-x1 " * (k % 3) for k in range(40)]
    texts += ["", "abcdef" * 30, "z" * 200, "\ud800 letters"]
    want = [0] * (len(secret_scan.CLASSES) * secret_scan.BINS)
    for text in texts:
        letters = re.sub("[^a-z]", "", text.lower() if text.isascii() else re.sub("[A-Z]", lambda m: m[0].lower(), text))
        for n in secret_scan.CLASSES:
            for i in range(0, len(letters) - n + 1, n):
                want[secret_scan._cell(letters[i : i + n])] += 1
    assert secret_scan.plain_counts(texts).tolist() == want
    assert sum(want) > 5 * len(texts) * len(secret_scan.CLASSES)
    valid = texts[:-1]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(valid)] + [(99, None)], "doc_id long, text string")
    got = secret_scan.scan(df).selectExpr("inline(plain)").groupBy("cell").sum("n").collect()
    assert {r[0]: r[1] for r in got} == {k: int(v) for k, v in enumerate(secret_scan.plain_counts(valid)) if v}


def test_redaction_learns_from_letters_of_the_whole_text(spark):
    """The pipeline's scan sees runs that stand before the middle of a text."""
    df = spark.createDataFrame([(1, "plain letters only " * 20 + "7 " * 400)], "doc_id long, text string")
    counts = secret_scan.scan(df).selectExpr("inline(plain)").agg({"n": "sum"}).first()[0]
    assert counts == sum(16 * 20 // n for n in secret_scan.CLASSES)


def test_redaction_keeps_rows_and_hides_secrets(docs):
    got = secret_scan.redact(docs)
    assert got.columns == docs.columns and got.count() == docs.count()
    text = got.filter("doc_id = 5").first()["text"]
    assert KEY not in text and "AKIA" not in text and text.count("[secret]") >= 3


# 2


def test_top_k_is_exact(spark):
    noise = np.random.default_rng(2)
    x = noise.normal(size=(400, 8)).round(2)
    x[300:] = x[5]  # ties and a hot vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(1000, None), (1001, [1.0, None] + [0.0] * 6), (1050, [float("nan")] * 8), (None, [1.0] * 8), (1100, [2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as score", "2 as rank")
    got = [tuple(r) for r in mtree.top_k(df, df.filter("vec_id % 50 = 0")).orderBy("query_id", "rank").collect()]
    y = np.floor(256 * x).astype(int)
    want = []
    for q in range(0, 400, 50):
        best = sorted((-int(y[q] @ y[i]), i) for i in range(400) if i != q)[:5]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    assert got == want
    assert mtree.top_k(df.limit(0), df).count() == 0


def test_stored_bounds_avoid_computations():
    noise = np.random.default_rng(3)
    centres = noise.integers(-200, 200, (40, 8))
    x = (np.repeat(centres, 50, axis=0) + noise.integers(-3, 4, (2000, 8))).astype(float)
    page = mtree.Page(np.arange(2000), x, float((x * x).sum(1).max()))
    for q in range(0, 2000, 100):
        best = sorted(page.search(q, x[q], 5, -np.inf), reverse=True)
        want = sorted(((x[q] @ x[i], -i) for i in range(2000) if i != q), reverse=True)[:5]
        assert best == want
    assert page.computed < 20 * 2000


# 3


def test_join_equals_brute_force(spark):
    noise, texts = np.random.default_rng(4), {}
    for k in range(40):
        words = noise.choice(WORDS, 60).tolist()
        for c in range(6 if k == 0 else 1 + k % 3):
            copy = list(words)
            for place in noise.integers(0, 60, c % 3):
                copy[place] = f"new{place}"
            texts[len(texts)] = " ".join(copy)
    n = len(texts)
    texts |= {n: "two words", n + 1: "two words", n + 2: "", n + 3: None}
    rows = [*texts.items(), (None, texts[0])]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as node", "1 as bands")
    sets = [frozenset(jaccard.ngrams(t or "", 5).tolist()) for _, t in rows]
    links = [
        (a, b)
        for a in range(len(rows))
        for b in range(len(rows))
        if a != b and sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    ]
    count, root = Counter(a for a, _ in links), list(range(len(rows)))
    for _ in rows:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    want = [(i, rows[root[a]][0] if sets[a] else i, count[a]) for a, (i, _) in enumerate(rows)]
    got = by_id(jaccard.similar_documents(df), "class_id", "n_links")
    assert got == sorted(want, key=repr)
    assert jaccard.similar_documents(df.limit(0)).count() == 0
    kept = jaccard.one_of_each(df)
    assert sorted(r["doc_id"] for r in kept.filter("doc_id is not null").collect()) == sorted({w[1] for w in want})


def test_large_groups_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "UNIT", 400)
    rows = [(i, prose(7, 60) + f" tail{i}") for i in range(60)]
    got = jaccard.similar_documents(spark.createDataFrame(rows, "doc_id long, text string"))
    assert by_id(got, "class_id", "n_links") == sorted([(i, 0, 59) for i in range(60)], key=repr)


def test_links_of_two_long_texts_count_once(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "UNIT", 400)
    # Near copies of 300 words, each longer than half of UNIT: with some, no text is on the other side.
    rows = [(k, " ".join([*(f"w{k // 2}x{n}" for n in range(300)), f"tail{k}"])) for k in range(16)]
    got = jaccard.similar_documents(spark.createDataFrame(rows, "doc_id long, text string"))
    assert by_id(got, "class_id", "n_links") == sorted([(k, k // 2 * 2, 1) for k in range(16)], key=repr)


def test_one_row_of_each_class_is_kept(spark):
    a, b = prose(21, 60), prose(22, 60)
    rows = [(5, a), (5, a), (None, a), (3, a), (3, b), (None, b), (7, None), (None, ""), (8, "")]
    kept = jaccard.one_of_each(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("text", "doc_id"))
    want = [(a, 3), (b, 3), (None, 7), ("", None), ("", 8)]
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(want, key=repr)


def test_bands_reach_the_recall():
    b = jaccard.bands_for(0.8, 0.9995, 6)
    assert 1 - (1 - 0.8**6) ** b >= 0.9995 > 1 - (1 - 0.8**6) ** (b - 1)


def test_components(spark):
    edges = [(k, k + 1) for k in range(100, 140)] + [(7, 3), (3, 7), (5, 5), (3, 9)]
    got = components.connected_components(spark.createDataFrame(edges, "a long, b long"))
    want = [(k, 100) for k in range(100, 141)] + [(3, 3), (7, 3), (9, 3)]
    assert sorted(map(tuple, got.collect())) == sorted(want)


# 4


def library_ids(text):
    return Tokenizer.from_file(BYTE_BPE).encode(text, add_special_tokens=False).ids


def test_token_files_round_trip(spark, docs, empty, tmp_path):
    huffman.write_tokens(docs, str(tmp_path / "t"), BYTE_BPE, end_id=2)
    got = huffman.read_tokens(spark, str(tmp_path / "t")).orderBy("start").collect()
    start, tokenizer = 0, Tokenizer.from_file(BYTE_BPE)
    ids = sorted([*TEXTS, 2], key=lambda i: -1 if i is None else i)
    for row, i in zip(got, ids, strict=True):
        want = np.array([*tokenizer.encode(TEXTS[i] or "", add_special_tokens=False).ids, 2], "<u4").tobytes()
        assert (row["doc_id"], row["start"], row["n_tokens"]) == (i, start, len(want) // 4)
        assert bytes(row["ids"]) == want and row["ids_crc32"] == zlib.crc32(want)
        start += len(want) // 4
    huffman.write_tokens(empty, str(tmp_path / "e"), BYTE_BPE, end_id=2)
    assert huffman.read_tokens(spark, str(tmp_path / "e")).count() == 0


def test_code_lengths_are_optimal_within_the_limit():
    import heapq

    counts = np.random.default_rng(5).zipf(1.3, 500) % 100_000 + 1
    heap, size = [(int(c), k) for k, c in enumerate(counts)], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        size += a[0] + b[0]
        heapq.heappush(heap, (a[0] + b[0], -1))
    assert int((huffman.code_lengths(counts, 30) * counts).sum()) == size
    short = huffman.code_lengths(counts, 10)
    assert short.max() <= 10 and sum(2.0 ** -int(n) for n in short) <= 1
    assert huffman.code_lengths(np.array([5])).tolist() == [1]


# 5


def test_forward_and_counts_equal_plain_recursions():
    noise = np.random.default_rng(6)
    counts = hmm.Counts(noise.integers(1, 9, 20), noise.integers(1, 4, 20))
    model = hmm.Hmm.first(counts, 3)
    sizes = np.array([1, 200, 64, 65, 3])
    seen = noise.integers(0, 20, sizes.sum())
    start, moves, emit, like = hmm.Lanes(seen, sizes).expect(model)
    total, w_start, w_moves, w_emit, at = 0.0, np.zeros(3), np.zeros((3, 3)), np.zeros((3, 20)), 0
    for n in sizes:
        x = seen[at : at + n]
        at += n
        alpha, scales = [model.start], []
        for o in x:
            a = (alpha[-1] @ model.moves) * model.emit[:, o]
            scales.append(a.sum())
            alpha.append(a / a.sum())
        beta = np.ones(3)
        for t in range(n, 0, -1):
            w_emit[:, x[t - 1]] += alpha[t] * beta / (alpha[t] @ beta)
            ahead = model.emit[:, x[t - 1]] * beta
            w_moves += alpha[t - 1][:, None] * model.moves * ahead[None, :] / scales[t - 1] / (alpha[t] @ beta)
            beta = model.moves @ ahead / scales[t - 1]
        w_start += model.start * beta / (model.start @ beta)
        total += np.log(scales).sum()
    assert np.allclose([like], [total]) and np.allclose(start, w_start)
    assert np.allclose(moves, w_moves) and np.allclose(emit, w_emit)


def test_base_scores(docs, empty):
    got = hmm.score_texts(docs).collect()
    tokens = [(r, [*(w for w in re.split(r"[\x20\x09-\x0d]+", (TEXTS[r] or "").translate({c: c + 32 for c in range(65, 91)})) if w), "\n"]) for r in [*TEXTS, 2]]
    count = Counter(t for i, ws in tokens if not hmm.held_out(i) for t in ws)
    n, v = sum(count.values()), len(count)
    want = sorted(
        ((i, hmm.held_out(i), len(ws), sum(count[w] > 0 for w in ws), n, round(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 6)) for i, ws in tokens),
        key=repr,
    )
    assert sorted(((r[0], r[1], r[2], r[3], r[4], round(r[5], 6)) for r in got), key=repr) == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    assert hmm.score_texts(empty).count() == 0


# 6


def test_bpe_equals_the_library(docs, empty):
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})

    def want(text):
        ids = reference.encode_ordinary(text)
        return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()

    got = bpe.bpe_digests(docs, RANKS, public_tokenizers.PATTERN)
    assert by_id(got, "n_tokens", "ids_sha256", "decoded_sha256") == expected(want)
    encoded = bpe.encode_bpe(docs, RANKS, public_tokenizers.PATTERN)
    back = bpe.decode_bpe(encoded, RANKS, public_tokenizers.PATTERN)
    assert by_id(back.selectExpr("doc_id", "decode(bytes, 'utf-8') as t"), "t") == expected(lambda t: (t,))
    assert bpe.bpe_digests(empty, RANKS, public_tokenizers.PATTERN).count() == 0
    long = ["ab" * 2000, "x" * 3000, "é1" * 1500]
    encoder = bpe.rank_encoder(RANKS, public_tokenizers.PATTERN)
    assert [x.tolist() for x in encoder.encode(long)] == [reference.encode_ordinary(t) for t in long]


# 7


def test_license_phrases_and_statements(docs, empty):
    def base(text):
        words = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate({c: c + 32 for c in range(65, 91)})) if w]
        found = [(k, name) for p, name in licenses.PHRASES.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
        places = [k for k, _ in found]
        return len(words), len(found), min(places, default=None), max(places, default=None), ",".join(sorted({n for _, n in found}))

    got = licenses.license_labels(docs)
    assert by_id(got, "n_words", "n_base", "first_word", "last_word", "base_labels") == expected(base)
    labels = {r["doc_id"]: (r["labels"], r["score"]) for r in got.collect()}
    assert labels[6] == ("cc-by,cc-by-nc,gpl,reserved", 1.0) and labels[0] == ("", 0.0)
    assert licenses.license_labels(empty).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_a_word_put_in_moves_the_diagonal(spark):
    text = "x y licensed under the well known apache license version 2 0 z. subject to the terms of the big mozilla public license v 2 0"
    rows, spans = licenses.find_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string"))
    assert rows.count() == 1
    found = {r["label"]: (r["first"], r["last"], r["share"]) for r in spans.collect()}
    assert found == {"apache": (2, 11, 1.0), "mpl": (13, 25, 1.0)}


# 8


def test_quality_statistics(docs, empty):
    def want(text):
        words = [w for w in re.split(r"[\x20\x09-\x0d]+", text) if w]
        lines = [x for x in text.split("\n") if x.strip("\x20\x09\x0a\x0b\x0c\x0d")]
        windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
        inside = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
        failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
        return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside), failed

    got = quality.quality_stats(docs)
    assert by_id(got, *quality.STATS, "base_failed") == expected(want)
    assert all(not (r["kept"] and r["base_failed"]) for r in got.collect())
    assert quality.quality_stats(empty).count() == 0
    assert quality.good_documents(docs).columns == docs.columns


def test_outliers_do_not_move_the_estimate(spark):
    noise = np.random.default_rng(8)
    rows = [(k, " ".join("w" * n + f"{j:03}" for j, n in enumerate(noise.integers(2, 7, int(noise.integers(80, 200))))), "en", "s") for k in range(300)]
    rows += [(1000 + k, " ".join(f"{'z' * 40}{k}{j}$$$$" for j in range(60)), "en", "s") for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"] for r in quality.quality_stats(df).filter("kept").collect()}
    good = {r["doc_id"] for r in quality.quality_stats(df).filter("not base_failed and doc_id < 1000").collect()}
    assert not any(k >= 1000 for k in kept) and len(good - kept) <= 3


# 9


@pytest.mark.parametrize("limits", [(1024, 64, 1024), (64, 3, 50)])
def test_packing_holds_every_id_once(docs, empty, limits):
    got = packing.pack_documents(docs, BYTE_BPE, 0, *limits).collect()
    tokenizer, by_doc, by_sequence = Tokenizer.from_file(BYTE_BPE), {}, {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for doc, pieces in by_doc.items():
        ids = np.array([*tokenizer.encode(TEXTS[doc] or "", add_special_tokens=False).ids, 0], "<u4")
        times = 2 if doc == 2 else 1
        covered = Counter(k for p in pieces for k in range(p["start"], p["start"] + p["length"]))
        assert covered == Counter({k: times for k in range(len(ids))})
        for p in pieces:
            assert p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(ids[p["start"] : p["start"] + p["length"]].tobytes())
    assert by_doc.keys() == TEXTS.keys()
    for pieces in by_sequence.values():
        pieces.sort(key=lambda p: p["offset"])
        assert [p["offset"] for p in pieces] == np.cumsum([0, *(p["length"] for p in pieces)])[:-1].tolist()
        assert sum(p["length"] for p in pieces) <= limits[0] and len(pieces) <= limits[1]
        assert sum(p["loss_tokens"] for p in pieces) <= limits[2]
    assert packing.pack_documents(empty, BYTE_BPE).count() == 0


def test_dot_product_choice():
    tokens, loss = np.array([10, 600, 500]), np.array([10, 600, 0])
    assert packing.choose(tokens, loss, [1024, 4, 1024], (1024, 4, 1024)) == 1
    assert packing.choose(tokens, loss, [1024, 4, 5], (1024, 4, 1024)) == 2
    assert packing.choose(tokens, loss, [5, 4, 5], (1024, 4, 1024)) == -1


# 10


def test_toxic_words_are_learned(spark, empty):
    noise, rows, labels = np.random.default_rng(10), [], []
    for k in range(600):
        toxic = k % 6 == 0
        words = noise.choice(WORDS, 40).tolist()
        if toxic:
            words[5] = words[20] = "vilest"
        rows.append((k, " ".join(words)))
        if k % 5 == 0:
            labels.append((k, int(toxic)))
    df = spark.createDataFrame(rows + [(None, None)], "doc_id long, text string").selectExpr("*", "7 as score")
    marks = spark.createDataFrame(labels + [(None, 1), (2, None)], "doc_id long, toxic int")
    got = toxicity.score_toxicity(df, marks).collect()
    assert len(got) == 601 and all(0 <= r["score"] <= 1 for r in got)
    for r in got:
        if r["doc_id"] is not None:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
            assert r["predicted"] == (r["score"] >= 0.3)
    right = [r["predicted"] == (r["doc_id"] % 6 == 0) for r in got if r["held_out"]]
    assert sum(right) >= 0.95 * len(right)
    assert toxicity.score_toxicity(empty, marks).count() == 0
    assert toxicity.score_toxicity(df, marks.limit(0)).count() == 601


@pytest.fixture
def fitted(monkeypatch):
    """The arguments that ``toxicity.fit`` is called with."""
    calls, fit = [], toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda *a: (calls.append(a), fit(*a))[1])
    return calls


def test_samples_hold_4000_toxic_and_12000_other_texts(spark, fitted):
    df = spark.range(20000).selectExpr("id as doc_id", "'a text of few words' as text")
    toxicity.learn(df, df.selectExpr("doc_id", "cast(doc_id % 3 = 0 as int) as toxic"))
    assert [len(side) for side in fitted[0][:2]] == [4000, 12000]


def test_repeated_ids_do_not_fill_the_samples(spark, fitted, monkeypatch):
    monkeypatch.setattr(toxicity, "POSITIVES", 20)
    monkeypatch.setattr(toxicity, "UNLABELLED", 50)
    monkeypatch.setattr(toxicity, "LEAST_TEXTS", 1)
    same = [(k, f"text{k} of few words") for k in range(200) if zlib.crc32(str(k).encode()) % 4 != 2]
    hot = [(same[k][0], t) for k in range(4) for t in ["the same row"] * 300 + [f"other{j}" for j in range(5)]]
    df = spark.createDataFrame(same + hot, "doc_id long, text string").repartition(5)
    marks = spark.createDataFrame([(i, 1) for i, _ in same], "doc_id long, toxic int")
    toxicity.learn(df, marks)
    assert [len(side) for side in fitted[0][:2]] == [20, 50]
    # 'the same row' of four ids stands in each sample four times at most.
    place = fitted[0][2].index(b"row") if b"row" in fitted[0][2] else -1
    assert all(sum(place in np.frombuffer(t, "<i4") for t in side) <= 4 for side in fitted[0][:2])


def test_words_of_few_toxic_texts_are_learned(spark):
    noise, rows = np.random.default_rng(13), []
    for k in range(2400):
        words = noise.choice(WORDS, 30).tolist()
        if k % 6 == 0:
            words[3] = "vilest"
        rows.append([k, words])
    few = [words for k, words in rows if k % 6 == 0 and zlib.crc32(str(k).encode()) % 4 != 2][:4]
    for words in few:
        words[3] = "raro"
    df = spark.createDataFrame([(k, " ".join(words)) for k, words in rows], "doc_id long, text string")
    model = toxicity.learn(df, df.selectExpr("doc_id", "cast(doc_id % 6 = 0 as int) as toxic"))
    assert model.weights[b"vilest"] > 0 and model.weights[b"raro"] > 0


def test_calibration_restores_shrunk_margins():
    noise = np.random.default_rng(12)
    f = np.concatenate([noise.normal(3, 1, 1000), noise.normal(-3, 1, 9000)])
    scale, shift = toxicity.calibrate(f[:1000] * 0.2, f * 0.2, 0.1)
    score = 1 / (1 + np.exp(-(scale * 0.2 * f + shift)))
    assert np.mean(score[:1000] >= 0.3) > 0.95 and np.mean(score[1000:] >= 0.3) < 0.02


def test_chunks_encoded_together_equal_the_library():
    rng = np.random.default_rng(4)
    bits = [" ", "  ", "\n", "\t", "a", "the", "'s", "12", " x", "<|endoftext|>", "é", " ", "　", "日本", ".", " !", "\x00"]
    texts = ["".join(rng.choice(bits, rng.integers(0, 40))) for _ in range(500)] + ["", " ", "long" * 3000]
    encoder = tokens.ChunkEncoder(BYTE_BPE)
    want = Tokenizer.from_file(BYTE_BPE).encode_batch(texts, add_special_tokens=False)
    for _ in range(2):  # with new and with remembered chunks
        assert [x.tolist() for x in encoder.encode(texts)] == [x.ids for x in want]
    encoder.n_bytes[:] = 1  # places of chunks that can't be told from the bytes
    encoder.clear()
    assert [x.tolist() for x in encoder.encode(texts)] == [x.ids for x in want]

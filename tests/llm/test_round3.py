"""Phrase mining, spelling variants and circulant MinHash against brute-force versions."""

import itertools

import numpy as np
import pytest

pytest.importorskip("pathkin.llm")

from pathkin.llm import circulant, jaccard

BASE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed: int, n: int) -> list[str]:
    return list(np.random.default_rng(seed).choice(BASE, n))


def edited(words: list[str], seed: int, edits: int) -> str:
    rng = np.random.default_rng(seed)
    out = list(words)
    for _ in range(edits):
        out[int(rng.integers(len(out)))] = f"x{int(rng.integers(1 << 30))}"
    return " ".join(out)


def near_texts() -> dict:
    a, b = prose(1, 400), prose(2, 300)
    texts = {
        1: " ".join(a),
        2: " ".join(a),  # exact copy
        3: edited(a, 3, 4),  # near copy
        4: edited(a, 4, 4),
        5: " ".join(b),
        6: edited(b, 6, 2).upper(),  # A-Z are lower-cased
        7: edited(b, 7, 60),  # too far
        8: None,
        9: "",
        10: "one two",
        11: "ONE two",
        12: " \t\n ",
        13: "Ünïcode WORDS here " * 3,
        None: " ".join(a),
    }
    # A chain of copies, each a little further from the first.
    chain = prose(20, 200)
    for k in range(6):
        chain = edited(chain, 100 + k, 1).split()
        texts[20 + k] = " ".join(chain)
    return texts


def brute(texts: dict) -> dict:
    ids = list(texts)
    sets = {i: set(circulant.shingles(t).tolist()) for i, t in texts.items()}
    parent = list(range(len(ids)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, y in itertools.combinations(range(len(ids)), 2):
        a, b = sets[ids[x]], sets[ids[y]]
        if a and b and 100 * len(a & b) >= 85 * len(a | b):
            parent[top(x)] = top(y)
    out = {}
    for x, i in enumerate(ids):
        members = [ids[y] for y in range(len(ids)) if top(y) == top(x) and ids[y] is not None]
        out[i] = (len(sets[i]), min(members) if members else None)
    return out


def test_circulant_near_duplicates_equal_brute_force(spark):
    texts = near_texts()
    rows = [(i, t, "en", 1) for i, t in texts.items()] + [(1, texts[1], "en", 1)]  # a repeated row
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, kept int").repartition(3)
    got = circulant.near_duplicates(docs).collect()
    want = brute(texts)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_shingles, r.component_id) == want[r.doc_id], r
        assert r.kept == (r.doc_id is not None and r.doc_id == r.component_id)
    assert want[3][1] == 1 and want[6][1] == 5 and want[7][1] == 7 and want[10] == (1, 10)


def test_links_between_nodes_that_lead_no_bucket(spark, monkeypatch):
    """Pairs of near copies whose every shared bucket is led by a far text are linked all the same."""
    texts, pairs = [], 20
    for k in range(pairs):
        text = prose(500 + k, 120)
        texts += [" ".join(text), edited(text, 900 + k, 1)]
    texts = ["far from all of the others"] + texts
    sets = [circulant.shingles(t) for t in texts]
    assert all(100 * len(np.intersect1d(a, b)) >= 85 * len(np.union1d(a, b)) for a, b in zip(sets[1::2], sets[2::2]))

    def one_bucket(signature, rows=circulant.ROWS):
        return np.tile(np.arange(signature.shape[1] // rows, dtype=np.uint64), (len(signature), 1))

    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    for unit in (700, jaccard.UNIT):
        monkeypatch.setattr(jaccard, "UNIT", unit)
        plain = circulant._sketch

        def sketched(batches, bucket=one_bucket):
            # Runs in a worker, whose module still has the plain _sketch.
            kept, circulant.band_hashes = circulant.band_hashes, bucket
            try:
                yield from circulant._sketch(batches)
            finally:
                circulant.band_hashes = kept

        monkeypatch.setattr(circulant, "_sketch", sketched)
        got = {r.doc_id: r.component_id for r in circulant.near_duplicates(docs).collect()}
        monkeypatch.setattr(circulant, "_sketch", plain)
        assert got == {0: 0} | {i: i - (i + 1) % 2 for i in range(1, 2 * pairs + 1)}


def test_circulant_empty_and_details(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert circulant.near_duplicates(docs).count() == 0
    assert circulant.shingles("a B c").tolist() == circulant.shingles("A b C").tolist()
    assert len(circulant.shingles("a b")) == 1 and len(circulant.shingles(None)) == 0
    sets = [circulant.shingles(" ".join(prose(s, 50))) for s in range(3)]
    sig = circulant.signatures(sets + [np.zeros(0, np.uint64)])
    assert sig.shape == (4, circulant.ROWS * circulant.BANDS) and (sig[3] == np.iinfo(np.uint64).max).all()
    # Each coordinate agrees between two sets with probability equal to their Jaccard similarity.
    # Shingle hashes are spread over all 64 bits (the first permutation).
    a = np.random.default_rng(1).integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2)
    b = np.concatenate([a[:3000], a[4000:]])
    a = a[:4000]
    s = circulant.signatures([np.unique(a), np.unique(b)], 2000)
    assert abs((s[0] == s[1]).mean() - 3000 / 5000) < 0.04


def test_circulant_long_text(spark):
    text = " ".join(prose(5, 30000))
    docs = spark.createDataFrame([(1, text), (2, text + " end"), (3, "short")], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in circulant.near_duplicates(docs).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def phrase_docs():
    rng = np.random.default_rng(7)
    small = BASE[:8] + ["Ünï", "dé"]
    rows = []
    for i in range(1500):
        n = int(rng.integers(0, 60))
        words = list(rng.choice(small, n))
        text = " ".join(words)
        if i % 3 == 0:
            text = text.replace(" beta ", ". Beta\t")
        if i % 5 == 0:
            text += " alpha beta gamma delta epsilon zeta"
        rows.append((i, text, ["en", "de", None][i % 3]))
    rows += [(None, None, "en"), (1000, "", "en"), (1001, "ALPHA BETA GAMMA " * 30000, "fr")]
    return rows


def test_phrase_trie_spills_equal_counter():
    from collections import Counter

    from pathkin.llm import phrases

    texts = [t or "" for _, t, _ in phrase_docs()[:200]]
    want = Counter()
    for t in texts:
        for words in phrases.pieces(t):
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    want[" ".join(words[i : i + k])] += 1
    old = phrases.BURST
    phrases.BURST = 3
    try:
        trie, got = phrases.PhraseTrie(limit=50), Counter()
        for t in texts:
            counts = Counter()
            for words in phrases.pieces(t):
                phrases._grams(words, counts)
            for _, phrase, _, c in trie.add("x", counts):
                got[phrase] += c
        for _, phrase, _, c in trie.spill():
            got[phrase] += c
    finally:
        phrases.BURST = old
    assert got == want


def test_collocations_equal_their_sql(spark, tmp_path):
    import duckdb
    import pandas as pd

    from pathkin.llm import phrases

    rows = phrase_docs()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = sorted(tuple(r) for r in phrases.collocations(docs).collect())
    documents = pd.DataFrame(rows, columns=["doc_id", "text", "lang"])
    want = sorted(tuple(r) for r in duckdb.sql(phrases.ORACLE.replace("FROM documents", "FROM documents")).fetchall())
    assert got == want and len(got) > 20
    assert {r[0] for r in got} == {"en", "de", "und", "fr"}
    assert phrases.collocations(docs.limit(0)).count() == 0


def variant_rows():
    rng = np.random.default_rng(3)
    stems = ["colour", "behaviour", "organise", "analysing", "théâtre", "naïveté", "straße", "encyclopaedia"]
    rows, i = [], 0
    for stem in stems:
        forms = [stem, stem[:-1], stem + "s", stem[:2] + "x" + stem[3:], stem[:3] + stem[4:], "q" + stem]
        for k, form in enumerate(forms):
            for _ in range(int(rng.integers(1, 4)) * (30 if k == 0 else 2) + (k == 2) * 4):
                rows.append((i, f"The {form.upper() if i % 7 == 0 else form}, and {form}!", "en"))
                i += 1
    rows += [(None, "colour colour colour colour colour", "en"), (i + 1, None, "en"), (i + 2, "", "en")]
    rows += [(i + 3, "abcdefgh " * 3000, "en")]
    return rows


def brute_variants(rows):
    import re
    import zlib

    counts = {}
    for doc_id, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
            if doc_id is not None:
                h = zlib.crc32(f"{doc_id}:{run}".encode())
                if h % 199 == 0:
                    p = h % len(run)
                    run = run[:p] + run[p + 1 :]
            counts[run] = counts.get(run, 0) + 1
    vocab = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}

    def one_edit(a, b):
        if a == b or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        if len(a) > len(b):
            a, b = b, a
        return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    out = {}
    for w, n in vocab.items():
        near = [v for v in vocab if one_edit(w, v)]
        best = min(near, key=lambda v: (-vocab[v], v)) if near else None
        form = best if best is not None and vocab[best] >= 5 * n else None
        out[w] = [form, n, len(near), vocab[form] if form else None]
    for w, row in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        row.append(root)
    return {w: (f, root, n, k, fn) for w, (f, n, k, fn, root) in out.items()}


def test_spelling_variants_equal_brute_force(spark):
    from pathkin.llm import variants

    rows = variant_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in variants.spelling_variants(docs).collect()}
    want = brute_variants(rows)
    assert got == want
    assert any(v[0] for v in want.values())
    assert variants.spelling_variants(docs.limit(0)).count() == 0


def test_spelling_variants_in_a_grid_of_cells(spark):
    from pathkin.llm import variants

    old = variants.CELL
    variants.CELL = 3
    try:
        rows = variant_rows()
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in variants.spelling_variants(docs).collect()}
    finally:
        variants.CELL = old
    assert got == brute_variants(rows)


def test_find_one_edit():
    from pathkin.llm import variants

    rests = sorted(["abc", "abd", "ab", "abcd", "xbc", "bc", "abcde", "acb", "zzz"])
    assert sorted(set(variants._find(rests, "abc"))) == ["ab", "abcd", "abd", "bc", "xbc"]
    assert sorted(set(variants._find(rests, ""))) == []
    assert sorted(set(variants._find(["a"], ""))) == ["a"]


def test_end_marks_are_not_encoded_again():
    """Ids are the library's; a word met with other marks is not given to it again."""
    from pathkin.llm.queries import BYTE_BPE
    from pathkin.llm.tokens import ChunkEncoder

    encoder = ChunkEncoder(BYTE_BPE)
    texts = [
        "Word, word. a word; word! word", "word, word", "a.", ". a ..b. ,", "x², y².\n z!?", "it's; don't, 's.",
        "a\n. b", "ß. é, e\u0301. ١٢,", "<|endoftext|>. <|endoftext|>,a", "  two  spaces. ", "語、 ª, ⅷ! _. a_;",
    ]
    whole = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids.tolist() for ids in encoder.encode(texts)] == whole
    given = []
    ids_of, encoder._ids = encoder._ids, lambda chunks, ends: (given.extend(chunks), ids_of(chunks, ends))[1]
    encoder.clear()
    assert [ids.tolist() for ids in encoder.encode(texts)] == whole
    assert [c for c in given if c.startswith(" word")] == [" word"]


def test_rare_phrases_do_not_leave_their_tasks(spark):
    """From two words on, only phrases whose parts are frequent are counted; shared bits change no result."""
    from pathkin.llm import phrases

    rows = [(i, f"aa bb cc r{i} s{i} aa bb cc; dd t{i} aa,bb", "en") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    texts = phrases._texts(docs, "text", "lang")
    words = phrases.phrase_counts(texts, 1)
    assert words.count() == 4 + 3 * 300
    frequent = words.filter("f >= 100")
    known = phrases.frequent_bits(frequent, frequent.count())
    pairs = {r.phrase: r.f for r in phrases.phrase_counts(texts, 2, known).collect()}
    assert pairs["aa bb"] == pairs["bb cc"] == 600 and len(pairs) < 300
    runs = phrases.frequent_runs(texts, phrases.frequent_bits(spark.createDataFrame([("en", "aa bb"), ("en", "bb cc")], "lang string, phrase string"), 2))
    assert {p for r in runs.collect() for p in bytes(r.text).split(b".")} >= {b"aa bb cc"}
    want = sorted(tuple(r) for r in phrases.collocations(docs).collect())
    old = phrases.MOST_BITS
    phrases.MOST_BITS = 1
    try:
        assert sorted(tuple(r) for r in phrases.collocations(docs).collect()) == want
    finally:
        phrases.MOST_BITS = old

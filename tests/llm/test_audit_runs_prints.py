"""Operators 11 to 13 against brute force on small inputs."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from starledger.llm import catalog, divergence, fingerprint, periodic_runs

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long, uid long, term string, part int, idx long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ------------------------------------------------- 11 source divergence audit
def brute_audit(rows, min_docs, top):
    """rows: (lang, source, text)."""
    rows = [tuple(v or "" for v in r) for r in rows]
    words = [[re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t)] for _, _, t in rows]
    out = []
    for lang in {r[0] for r in rows}:
        mine = [(r[1], w) for r, w in zip(rows, words) if r[0] == lang]
        held = collections.Counter(t for _, w in mine for t in set(w))
        kept = sorted((t for t, n in held.items() if n >= min_docs), key=str.encode)
        counts = {s: collections.Counter() for s, _ in mine}
        for s, w in mine:
            counts[s].update(t for t in w if t in set(kept))
        every = sum(counts.values(), collections.Counter())

        def share(c):
            below = sum(c.values()) + 5 * len(kept)
            return {t: 1 + 10 ** 9 * (c[t] + 5) // below for t in kept}
        q, p = share(every), {s: share(c) for s, c in counts.items()}
        for s in counts:
            pairs = sorted(((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in counts if o != s))
            over = sorted((-(p[s][t] - q[t]), t.encode(), t) for t in kept if counts[s][t] and p[s][t] > q[t])
            out += [(lang, s, "pair", o, -v, i + 1) for i, (v, _, o) in enumerate(pairs)]
            out += [(lang, s, "term", t, -v, i + 1) for i, (v, _, t) in enumerate(over[:top])]
    return sorted(out)


def audit_rows(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, g, s, None, 1, "x", 2, 3) for i, (g, s, t) in enumerate(rows)], DOC)
    got = divergence.audit(df, **kw)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(map(tuple, got.collect()))


def audit_input(seed, docs=120, sources=7):
    r = random.Random(seed)
    vocab = ["The", "the", "ÄB", "äb", "été", "東京", "x1y", "a-b", "z"] + [f"w{c}{d}" for c in "abcde" for d in "fghij"]
    rows = []
    for i in range(docs):
        source = None if i % 11 == 0 else f"s{min(r.randrange(sources), r.randrange(sources))}"
        lang = None if i % 13 == 0 else r.choice(["en", "en", "en", "de"])
        text = None if i % 17 == 0 else " ".join(r.choice(vocab[:1 + r.randrange(len(vocab))]) for _ in range(r.randrange(40)))
        rows.append((lang, source, text))
    return rows + rows[:20] + [("empty", "a", ""), ("empty", "b", None), ("one", "a", "some words"), ("en", "silent", "12 34"), ("en", "s0", "q" * 50 + " the" * 9000)]


@pytest.mark.parametrize("seed", [1, 2])
def test_audit_equals_brute_force(lspark, seed):
    rows = audit_input(seed)
    assert audit_rows(lspark, rows, min_docs=5, top=4) == brute_audit(rows, 5, 4)


def test_audit_in_small_blocks(lspark):
    rows = audit_input(3, docs=90, sources=12)
    assert audit_rows(lspark, rows, min_docs=3, top=6, block=3, terms_each=4) == brute_audit(rows, 3, 6)


def test_terms_of_texts():
    texts = [b"", b"  ", b"A b a-B", "Été x 東京".encode(), b"last"]
    terms, text = divergence._terms(texts)
    got = [(terms.dictionary[i].as_py(), t) for i, t in zip(terms.indices.to_pylist(), text.tolist())]
    assert got == [(b"a", 2), (b"b", 2), (b"a", 2), (b"b", 2)] + [(w.encode(), 3) for w in ("Été", "x", "東京")] + [(b"last", 4)]
    assert len(divergence._terms([b""])[1]) == 0


@pytest.mark.parametrize("piece", [1, 4 << 20])
def test_term_counts_in_pieces(lspark, piece):
    docs = lspark.createDataFrame([(0, "a b a", "en", "s", 1, 1, "", 1, 1), (0, "A c", "en", "s", 1, 1, "", 1, 1), (0, "c", "en", "t", 1, 1, "", 1, 1)], DOC).coalesce(1)
    table = divergence.kept_counts(docs, min_docs=2, piece=piece, rows_each=1)
    assert sorted({(r.source, r.term, r.n, r.lang_n) for r in table.collect()}) == [("s", "", 0, 0), ("s", "a", 3, 3), ("s", "c", 1, 2), ("t", "", 0, 0), ("t", "c", 1, 2)]
    assert table.where("term <> ''").count() == 3


def test_audit_without_rows(lspark):
    assert audit_rows(lspark, [], min_docs=1) == []
    assert audit_rows(lspark, [("en", "a", "x y")], min_docs=2) == []


@pytest.mark.parametrize("seed", range(6))
def test_skyband_keeps_what_few_dominate(seed):
    r = np.random.default_rng(seed)
    n, k = 200, 1 + seed
    gain, cost, name = r.integers(0, 12, n), r.integers(0, 12, n), r.permutation(n)
    want = [sum((gain >= gain[i]) & (cost <= cost[i]) & (name < name[i])) < k for i in range(n)]
    assert divergence.skyband(gain, cost, name, k).tolist() == want


def test_skybands_over_many_partitions(lspark):
    r = random.Random(5)
    rows = [("en", f"s{r.randrange(3)}", f"t{i:04d}", r.randrange(30), r.randrange(30, 90), r.randrange(100)) for i in range(900)]
    points = lspark.createDataFrame(rows, "lang string, source string, term string, n long, lang_n long, value long").repartition(9)
    got = sorted(x.term for x in divergence.skybands(points, 3, fan_in=2).collect())
    want = sorted(a[2] for a in rows if sum(b[1] == a[1] and b[3] >= a[3] and b[4] <= a[4] and b[2] < a[2] for b in rows) < 3)
    assert got == want


# ------------------------------------------------- 12 periodic run detection
def brute_runs(words, min_length=6, exponent=4):
    n, runs = len(words), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(min_length, exponent * q):
                smallest = next(d for d in range(1, q + 1) if all(words[x] == words[x + d] for x in range(i, i + length - d)))
                if smallest == q:
                    runs.append((i, length, q))
            i = max(j, i + 1) if j == i else j + 1
    return sorted(runs, key=lambda r: (r[0], r[2]))


def brute_digest(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = sorted(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]))[0] if runs else None
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha("".join("%d,%d,%d\n" % r for r in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def test_runs_equal_brute_force_on_random_words():
    r = random.Random(12)
    texts = [[r.randrange(1 + r.randrange(4)) for _ in range(r.randrange(120))] for _ in range(300)]
    for _ in range(150):  # long periods, gaps inside the period, broken ends
        block = [r.randrange(3) for _ in range(r.randrange(1, 60))]
        times = r.randrange(2, 9)
        body = block * times + block[:r.randrange(len(block))]
        texts.append([r.randrange(3) for _ in range(r.randrange(30))] + body + [r.randrange(3) for _ in range(r.randrange(30))])
    numbers, base = [], 0
    for t in texts:  # a document's own numbers, below the number of words
        first = {}
        numbers.append(np.array([first.setdefault(w, base + i) for i, w in enumerate(t)], np.int64))
        base += len(t)
    found, at = periodic_runs.word_runs(np.concatenate(numbers), max(map(len, texts))), 0
    for t in texts:
        mine = [(s - at, n, q) for s, n, q in found if at <= s < at + len(t)]
        assert mine == brute_runs(t), t
        at += len(t)


@pytest.mark.parametrize("min_length, exponent", [(6, 4), (1, 3), (20, 3), (9, 6)])
def test_runs_with_other_limits(min_length, exponent):
    r = random.Random(exponent)
    for _ in range(120):
        block = [r.randrange(2) for _ in range(r.randrange(1, 20))]
        t = [r.randrange(2) for _ in range(9)] + block * r.randrange(2, 9) + [r.randrange(2) for _ in range(20)]
        first = {}
        got = periodic_runs.word_runs(np.array([first.setdefault(w, i) for i, w in enumerate(t)]), len(t), min_length, exponent)
        assert got == brute_runs(t, min_length, exponent)
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(None, exponent=2)


def test_run_query_equals_brute_force(lspark):
    r = random.Random(4)
    texts = [None, "", " \t\n", "one", "a " * 9000, "a b " * 700 + "\x0b a\x0cb", "ü 東京\x1c\xa0 " * 8, "x y z x y z x y z x y z", "A a A a A a A a"]
    texts += [" ".join(r.choice("abc") for _ in range(r.randrange(200))) for _ in range(60)] * 2
    rows = [(i if i % 9 else i // 2, t, None, None, None, 5, "t", 1, 1) for i, t in enumerate(texts)] + [(None, "b " * 50, "en", "s", 1, 1, "t", 1, 1)]
    df = lspark.createDataFrame(rows, DOC)
    want = sorted((brute_digest(x[0], x[1]) for x in rows), key=str)
    for held in (periodic_runs.WORDS_AT_ONCE, 300):
        got = periodic_runs.digests(periodic_runs.periodic_runs(df, edit=periodic_runs.planted, words_at_once=held)).drop("n_words")
        assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
        assert sorted(map(tuple, got.collect()), key=str) == want
    assert periodic_runs.periodic_runs(df.limit(0)).collect() == []


def test_run_query_on_given_documents(lspark):
    got = {r.doc_id: tuple(r)[:8] for r in catalog.queries()["op12_periodic_runs"](lspark, SF).collect()}
    docs = [d for d in lspark.read.parquet(f"{SF}/documents.parquet").collect() if len(d.text) < 6000]
    assert len(docs) > 100
    for d in docs:
        assert got[d.doc_id] == brute_digest(d.doc_id, d.text)


def test_collapsed_text_and_best_run(lspark):
    df = lspark.createDataFrame([(3, "go on a b a b a b a b end end")], "doc_id long, text string")
    row = periodic_runs.periodic_runs(df).first()
    assert [tuple(x) for x in row.runs] == [(2, 8, 2)] and tuple(row.best) == (2, 8, 2) and row.collapsed == "go on a b end end"
    assert periodic_runs.best_run([(0, 12, 3), (2, 8, 2), (40, 9, 2)]) == (40, 9, 2)


# ------------------------------------------------- 13 document fingerprints
def plain_samples(text, samples=64, seed=13):
    """The sampling, word by word and sample by sample in plain numbers."""
    mask = 2 ** 64 - 1

    def mix(x):
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & mask
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & mask
        return x ^ (x >> 31)
    stream = [[mix((0x9E3779B97F4A7C15 * (g * samples + s + 1) + seed) & mask) for s in range(samples)] for g in range(2)]
    weights = collections.Counter(re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m.group().lower(), text.encode())))
    out = []
    for s in range(samples):
        best = None
        for word, w in weights.items():
            h = xxhash.xxh64(word, seed=seed).intdigest()
            x = mix(h ^ stream[0][s])
            u = [((x >> i & 0xFFFF) + 0.5) / 65536 for i in (0, 16, 32, 48)]
            b = ((x * 0x9E3779B97F4A7C15 & mask) >> 48) / 65536 + 0.5 / 65536
            r, c = -np.log(u[0]) - np.log(u[1]), -np.log(u[2]) - np.log(u[3])
            t = np.floor(np.log(w) / r + b)
            a = np.log(c) - r * (t - b) - r
            if best is None or a < best[0]:
                best = (a, h, int(t))
        out.append(0 if best is None else mix(((mix(best[1] ^ stream[1][s]) + best[2]) & mask)) % 65535 + 1)
    return "".join("%04x" % x for x in out)


def texts_for_prints():
    r = random.Random(13)
    texts = [None, "", " \n", "One", "one", "ONE one one", "日本 語 日本 é É", "w " * 5000] + [" ".join(f"w{int(r.expovariate(.05))}" for _ in range(r.randrange(1, 150))) for _ in range(30)]
    return texts


def test_prints_equal_plain_numbers(lspark):
    texts = texts_for_prints()
    df = lspark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.fingerprint for r in fingerprint.fingerprints(df).collect()}
    assert [got[i] for i in range(len(texts))] == [plain_samples(t or "") for t in texts]
    assert got[0] == got[1] == got[2] == "0" * 256 and got[3] == got[4] != got[5]


def test_long_texts_in_pieces_and_a_full_cache(monkeypatch):
    want = [fingerprint.Sampler().of_text(t.encode()).tolist() for t in texts_for_prints()[3:]]
    monkeypatch.setattr(fingerprint, "WORDS_AT_ONCE", 7)
    monkeypatch.setattr(fingerprint, "WORDS_KEPT", 11)
    small = fingerprint.Sampler()
    assert [small.of_text(t.encode()).tolist() for t in texts_for_prints()[3:]] == want


def test_likeness_estimates_generalised_jaccard():
    r, sampler, errors = random.Random(7), fingerprint.Sampler(1024), []
    for pair in range(12):  # words of its own for each pair: independent errors
        a = collections.Counter({b"w%d-%d" % (pair, i): 1 + int(r.expovariate(.3)) for i in range(60) if r.random() < .7})
        b = collections.Counter({w: max(1, n + r.randrange(-2, 3)) for w, n in a.items() if r.random() < .8})
        b.update({b"x%d-%d" % (pair, i): 1 + r.randrange(3) for i in range(r.randrange(30))})
        true = sum((a & b).values()) / sum((a | b).values())
        errors.append(fingerprint.likeness(sampler.of_weights(a), sampler.of_weights(b)) - true)
    assert max(map(abs, errors)) < 4 * .5 / 1024 ** .5 and abs(sum(errors)) / len(errors) < .015


def brute_neighbours(rows):
    first = {}
    for doc_id, text in rows:
        key = fingerprint.LAST_ID if doc_id is None else doc_id
        first[key] = min(first.get(key, text or ""), text or "", key=str.encode) if key in first else text or ""
    ids = sorted(first)
    after = {k: first[ids[(i + 1) % len(ids)]] for i, k in enumerate(ids)}
    out = []
    for doc_id, text in rows:
        text, follows = text or "", after[fingerprint.LAST_ID if doc_id is None else doc_id]
        m = len(text) // 4
        edited = text[:len(text) - m] + follows[:m]
        a, b, c = (plain_samples(t, 16) for t in (text, edited, follows))
        like = [sum(a[i:i + 4] == x[i:i + 4] for i in range(0, 64, 4)) / 16 for x in (b, c)]
        out.append((doc_id, len(text), sha(edited), a, b, *like))
    return sorted(out, key=str)


@pytest.mark.parametrize("rows_each", [3, 50_000])
def test_edited_prints_equal_brute_force(lspark, rows_each):
    texts = texts_for_prints()[:28]
    ids = [(i * 7919) % 101 - 20 for i in range(len(texts))]
    rows = list(zip(ids, texts)) + [(ids[5], "hot " + str(i % 4)) for i in range(25)] + [(None, "no id"), (None, None), (ids[2], "b a"), (ids[2], "a 🙂 b")]
    df = lspark.createDataFrame([(i, t, None, None, None, 1, "x", 1, 1) for i, t in rows], DOC).repartition(5)
    got = fingerprint.digests(fingerprint.edited_fingerprints(df, samples=16, rows_each=rows_each))
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_neighbours(rows)


@pytest.mark.parametrize("rows", [[], [(5, "only one here")], [(1, "same text twice"), (1, "same text twice")], [(None, None)], [(7, "x")] * 9 + [(8, "y")] * 9])
def test_edited_prints_of_few_rows(lspark, rows):
    df = lspark.createDataFrame(rows, "doc_id long, text string")
    got = fingerprint.digests(fingerprint.edited_fingerprints(df, samples=16, rows_each=4))
    assert sorted(map(tuple, got.collect()), key=str) == brute_neighbours(rows)


def test_print_query_on_given_documents(lspark):
    docs = sorted(lspark.read.parquet(f"{SF}/documents.parquet").collect(), key=lambda d: d.doc_id)
    got = {r.doc_id: r for r in catalog.queries()["op13_fingerprint"](lspark, SF).collect()}
    assert len(got) == len(docs)
    for d, after in zip(docs, docs[1:] + docs[:1]):
        m, r = len(d.text) // 4, got[d.doc_id]
        assert r.n_chars == len(d.text) and r.edited_sha256 == sha(d.text[:len(d.text) - m] + after.text[:m])
        assert (r.near_next == 1.0) == (r.fingerprint == got[after.doc_id].fingerprint)
    by_text = collections.defaultdict(set)
    for d in docs:
        by_text[d.text].add(got[d.doc_id].fingerprint)
    assert all(len(v) == 1 for v in by_text.values())

"""The registered queries against plain Python on the small test tables, with
planted copies, leaks and insults in tables of their own."""

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from speechlens.llm import decontamination, language_id, minhash, mixing, rp_forest, secret_scan, toxicity

SF = "/root/testdata/sf0.01"


def read(table, columns):
    return duckdb.sql(f"SELECT {columns} FROM '{SF}/{table}.parquet'").fetchall()


@pytest.fixture(scope="module")
def texts():
    return {i: t or "" for i, t in read("documents", "doc_id, text")}


def rows_of(spark, name):
    return entry.queries()[name](spark, SF).collect()


def crc(i, n):
    return zlib.crc32(str(i).encode()) % n


def components(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def near_links(sets):
    ids, links = sorted(sets), []
    for n, a in enumerate(ids):
        for b in ids[:n]:
            x, y = sets[a], sets[b]
            if x and y and 4 * min(len(x), len(y)) >= 3 * max(len(x), len(y)):
                common = len(x & y)
                if 100 * common >= 75 * (len(x) + len(y) - common):
                    links.append((a, b))
    return links


def test_minhash_query(spark, texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    want = components(sets, near_links(sets))
    for r in rows_of(spark, "op6_minhash_neardup"):
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (
            len(sets[r["doc_id"]]), want[r["doc_id"]], want[r["doc_id"]] == r["doc_id"])


def test_minhash_of_edited_copies(spark):
    """A group of copies edited so that many pairs lie about the threshold."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(5000)]
    base, rows = rng.choices(words, k=150), []
    for i in range(150):
        copy = [rng.choice(words) if rng.random() < rng.choice([0, 0.02, 0.05, 0.08]) else w for w in base]
        rows.append((i, " ".join(copy)))
    rows += [(1000 + i, " ".join(rng.choices(words, k=60))) for i in range(50)]
    sets = {i: shingles(t) for i, t in rows}
    want = components(sets, near_links(sets))
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    assert got == want and len(set(want.values())) > 55


def test_minhash_of_a_large_group_about_the_threshold(spark):
    """2,000 copies of one text, most of them edited close to 0.75 or beyond: they
    share large buckets, so the exact prefix filter must find their links."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(4000)]
    base, edits = rng.choices(words, k=120), rng.choices(words, k=25)
    rows = []
    for i in range(2000):
        copy = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 6, 7])):
            # some edits are common to many copies, so difference sets overlap too
            k = rng.randrange(120) if rng.random() < 0.5 else rng.choice([7, 31, 55, 90])
            copy[k] = rng.choice(edits)
        rows.append((i, " ".join(copy)))
    sets = {i: shingles(t) for i, t in rows}
    want = components(sets, near_links(sets))
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    assert got == want and 20 < len(set(want.values())) < 1500


def test_prefix_filter_is_exact(spark):
    """All pairs about the threshold, of sizes that differ, from the filter alone."""
    rng = random.Random(12)
    sets = {}
    for i in range(300):
        of = set(range(i % 5 * 1000, i % 5 * 1000 + rng.randrange(30, 60)))
        sets[i] = {x for x in of if rng.random() < 0.9} | {rng.randrange(10_000, 10_050) for _ in range(rng.randrange(8))}
    rows = spark.createDataFrame([(i, sorted(s)) for i, s in sets.items()], "doc long, members array<long>")
    docs = spark.createDataFrame([(i, i, i % 3 == 0) for i in sets], "doc long, component long, unlinked boolean")
    pairs = {(min(r), max(r)) for r in minhash._prefix_pairs(rows, docs).collect()}
    want = {(a, b) for a in sets for b in sets if a < b and (a % 3 == 0 or b % 3 == 0)
            and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert want <= pairs and len(want) > 100 and len(pairs) < 300 * 299 / 4


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    for n in (1, 3, 40, 1000, 20_000):
        x = rng.integers(0, 2**63, n, dtype=np.uint64)
        assert (minhash.sketch(x) != minhash._EMPTY).all()
    a = rng.integers(0, 2**63, 400, dtype=np.uint64)
    b = np.concatenate([a[:300], rng.integers(0, 2**63, 100, dtype=np.uint64)])
    assert abs((minhash.sketch(a) == minhash.sketch(b)).mean() - 0.6) < 0.12


def test_forest_query_and_clusters(spark):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(12, 48))
    rows = [(i, (centre[i % 12] + rng.normal(size=48) * rng.choice([0, 0.1, 0.2, 0.3])).tolist()) for i in range(700)]
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    want = components(range(700), [(int(a), int(b)) for a, b in zip(*np.nonzero(near))])
    rp_forest.BLOCK, block = 64, rp_forest.BLOCK
    try:
        got = rp_forest.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    finally:
        rp_forest.BLOCK = block
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == {i: (int(near[i].sum()), want[i]) for i in range(700)}
    assert len(rows_of(spark, "op2_embedding_neardup")) == 500


def test_forest_is_deep_in_a_dense_cluster():
    """Pairs right at 0.95 in one cluster whose splits nearly all spill a third."""
    rng = np.random.default_rng(8)
    n, d = 6000, 48
    x = rng.normal(size=d) + rng.normal(size=(n, d)) * 0.45
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.normal(size=(n, d))
    side -= (side * x).sum(axis=1, keepdims=True) * x
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    points = np.vstack([x, 0.9501 * x + np.sqrt(1 - 0.9501 ** 2) * side])
    forest = rp_forest.fit_forest({d: (np.arange(2 * n), points)}, 2 * n, leaf=16)
    assert min(len(tree.median) for tree in forest[d]) > 30
    leaf, row = rp_forest._leaves_of(forest, d, points)
    held = collections.defaultdict(set)
    for k, i in zip(leaf.tolist(), row.tolist()):
        held[i].add(k)
    near = [(int(i), int(j)) for i, j in zip(*np.nonzero(np.triu(points @ points.T >= 0.95, 1)))]
    assert len(near) >= n
    assert [p for p in near if not held[p[0]] & held[p[1]]] == []
    assert np.prod([tree.miss for tree in forest[d]]) <= 1e-6


def test_pii_query(spark, texts):
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    card = re.compile(r"[0-9]([\x20-]?[0-9])+")
    phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

    def luhn(s):
        d = [int(c) for c in s][::-1]
        return (sum(d[::2]) + sum(sum(divmod(2 * v, 10)) for v in d[1::2])) % 10 == 0

    def digits(s):
        return re.sub("[^0-9]", "", s)

    for r in rows_of(spark, "op7_pii"):
        t = texts[r["doc_id"]]
        found = [("email", m) for m in email.finditer(t)] if "@" in t else []
        found += [("ip", m) for m in ip.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
        found += [("card", m) for m in card.finditer(t) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
        found += [("phone", m) for m in phone.finditer(t) if 8 <= len(digits(m[0])) <= 15]
        names = [f"{k}:{m.start()}:{m.end()}" for k, m in found]
        assert r["base_sha256"] == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert set(names) <= set(r["spans"].split(",")) | {""}
        assert r["n_email"] == sum(k == "email" for k, _ in found) and r["n_phone"] == sum(k == "phone" for k, _ in found)


def test_secrets_query(spark, texts):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
    for r in rows_of(spark, "op8_secrets"):
        t = texts[r["doc_id"]]
        found = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 6]
        found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        names = [f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found)]
        assert r["base_sha256"] == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert set(names) <= set(r["spans"].split(",")) | {""}


def test_secrets_of_a_text_with_thousands_of_runs(spark):
    """Spans of 8,000 runs and 2,000 assignments in one text, at their exact places."""
    rng = random.Random(31)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    words, want, at = [], [], 0
    for i in range(10_000):
        if i % 5 == 0:
            word = f"token={''.join(rng.choices(letters, k=30))}"
            want.append(f"assign:{at}:{at + len(word)}")
        else:
            word = "".join(rng.choices(letters, k=26))
        words.append(word)
        at += len(word) + 1
    row = secret_scan.scan_secrets(spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")).first()
    assert row["n_assign"] == 2000 and row["n_random"] >= 7900
    assert [x for x in row["spans"].split(",") if x.startswith("assign")] == want
    text = " ".join(words)
    assert all(text[x["start"]:x["end"]] == x["token"] for x in row["found"])


def test_secret_battery_separates_random_from_ordinary(spark):
    rng = random.Random(7)
    chars = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    rows = []
    for i in range(300):
        secret = "".join(rng.choices(chars, k=40))
        plain = "_".join(rng.choices(["section", "internal", "representation", "chapter", "house"], k=4)) + "_v2"
        rows.append((i, f"see {secret if i < 30 else plain} there" + (" ünï" if i % 2 else "")))
    out = secret_scan.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    flagged = {r["doc_id"] for r in out if r["n_random"]}
    assert len(flagged & set(range(30))) >= 27 and len(flagged - set(range(30))) <= 3


def test_language_model_query(spark, texts):
    count = collections.Counter()
    for i, t in texts.items():
        if crc(i, 10):
            count.update(t.encode().lower().split())
            count[None] += 1
    n, v = sum(count.values()), len(count)
    rows = rows_of(spark, "op4_lm_scoring")
    base = model = 0.0
    for r in rows:
        words = [*texts[r["doc_id"]].encode().lower().split(), None]
        want = sum(math.log10((count.get(w, 0) + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        assert r["base_score"] == pytest.approx(want, rel=1e-9)
        assert (r["n_tokens"], r["train_tokens"], r["n_known"]) == (len(words), n, sum(count.get(w, 0) > 0 for w in words))
        if r["held_out"]:
            base, model = base + r["base_score"], model + r["score"]
    assert model > base * 0.97


def test_log_bilinear_is_normalised():
    from speechlens.llm.lbl_lm import train_nce

    rng = np.random.default_rng(0)
    tokens = np.tile([1, 2, 3, 0], 3000)
    one, two = np.roll(tokens, 1), np.roll(tokens, 2)
    noise = np.bincount(tokens, minlength=6).astype(float)
    a, b, z = train_nce(tokens, one, two, noise, width=8, epochs=8, batch=256, shared=32).tables()
    for c1, c2 in rng.integers(0, 6, (5, 2)):
        assert np.exp(a[c1] + b[c2] - z[c1, c2]).sum() == pytest.approx(1, abs=1e-4)
    assert np.exp(a[1, 2] + b[0, 2] - z[1, 0]) > 0.5  # after 0 1 comes 2


def test_log_bilinear_learns_from_all_texts(spark):
    """What follows what is in every text, and the first sample is ten of 1,500."""
    from pyspark.sql import functions as F

    from speechlens.llm import lbl_lm

    rows = [(i, " ".join("abcd"[(i + k) % 4] for k in range(200))) for i in range(1600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    model, counts = lbl_lm.fit(docs, F.col("doc_id") < 1500, sample_tokens=2_000)
    out = lbl_lm.score(docs.where("doc_id >= 1500"), model, counts).collect()
    assert len(out) == 100 and sum(r["score"] for r in out) > 0.5 * sum(r["base_score"] for r in out)


@pytest.mark.parametrize("name, label, n, held, least", [("op9_quality", "quality", 5, 0, 0.95)])
def test_quality_query(spark, name, label, n, held, least):
    labels = dict(read("labels", f"doc_id, {label}"))
    rows = [r for r in rows_of(spark, name) if r["held_out"] and r["doc_id"] in labels]
    assert all(crc(r["doc_id"], n) == held for r in rows)
    assert np.mean([labels[r["doc_id"]] == r["predicted"] for r in rows]) >= least


def test_language_query(spark):
    lang = dict(read("documents", "doc_id, lang"))
    rows = rows_of(spark, "op3_language_id")
    assert all(r["held_out"] == (crc(r["doc_id"], 4) == 2) for r in rows)
    assert np.mean([lang[r["doc_id"]] == r["lang_pred"] for r in rows if r["held_out"]]) >= 0.98


def test_rare_languages_are_learned(spark):
    rng = random.Random(9)
    alphabet = {"aa": "abcdefgh", "bb": "fghijklm", "rare": "mnopqrst", "once": "uvwxyz"}
    text = lambda v: " ".join("".join(rng.choices(alphabet[v], k=5)) for _ in range(20))
    names = ["once"] + ["rare"] * 8 + ["aa", "bb"] * 1500
    train = spark.createDataFrame([(i, text(v), v) for i, v in enumerate(names)], "doc_id long, text string, lang string").repartition(3)
    tests = [(i, text(v), v) for i, v in enumerate(["aa", "bb", "rare", "once"] * 10)]
    for rows, bound in ((train, 300), (train.where("doc_id < 40"), 300)):
        model = language_id.fit(rows, bound=bound)
        assert model.languages == ("aa", "bb", "once", "rare")
        got = {r["doc_id"]: r["lang_pred"] for r in language_id.predict(spark.createDataFrame(tests, "doc_id long, text string, lang string"), model).collect()}
        assert got == {i: v for i, _, v in tests}
    assert language_id._quota([1, 8, 1500, 1500], 300) == 145 and language_id._quota([3, 4], 300) == 4


def test_toxicity_query_and_tolerance(spark):
    assert len(rows_of(spark, "op5_toxicity")) == 1000
    rng = random.Random(3)
    syllables = ["th", "er", "on", "an", "in", "tion", "ing", "ed", "st", "re", "ble", "ou", "ea", "nd", "ti", "en"]
    plain = lambda: " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(60))
    insults = ["idiot", "moron", "stupid", "clown"]
    rows = [(f"{plain()} {rng.choice(insults)}. {plain()}".encode(), 1) for _ in range(80)] + [(plain().encode(), 0) for _ in range(300)]
    rng.shuffle(rows)
    model = toxicity.fit_words(rows)
    score = lambda t: float(model.probability(max(toxicity.margins(toxicity.words_of(t.encode()), model.table, model.bias))))
    for bad in ("an idiot!", "you st*upid", "i d i o t", "MORON", "clo-wn here"):
        assert score(f"{plain()} {bad} {plain()}") >= 0.3, bad
    assert np.mean([score(plain()) < 0.3 for _ in range(200)]) >= 0.97


def test_decontamination_finds_edited_copies(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(20, 50)))) for i in range(30)]
    rows, leaked = [], set()
    for d in range(200):
        body = rng.choices(words, k=200)
        if d % 4 == 0:
            i, t = items[d % 30]
            edited = [rng.choice(words) if rng.random() < 0.1 else w for w in t.split()]
            del edited[len(edited) // 2]
            body[100:100] = edited
            leaked.add((d, i))
        rows.append((d, ". ".join([" ".join(body[:50]), " ".join(body[50:])])))
    found = decontamination.leaks(spark.createDataFrame(rows, "doc_id long, text string").repartition(4),
                                  spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r["doc_id"], r["item_id"]) for r in found}
    assert got == leaked


def smith_waterman(item, text):
    best, row = 0, [0] * (len(text) + 1)
    for w in item:
        above, row = row, [0]
        for j, v in enumerate(text):
            row.append(max(0, above[j] + (2 if v == w else -1), above[j + 1] - 1, row[j] - 1))
        best = max(best, *row)
    return best


def test_decontamination_with_a_common_half(spark):
    """One half of an item stands in most documents and the other in a few, and
    one document keeps two of three words: each is found for itself."""
    rng = random.Random(6)
    words = [f"w{i}" for i in range(2000)]
    items = [(i, rng.sample(words, 60)) for i in range(3)]
    rows = []
    for d in range(150):
        body, item = rng.choices(words, k=40), items[d % 3][1]
        part = item[30:] if d < 6 else item[:30] if d < 120 else []
        part = [w for k, w in enumerate(item) if k % 12 != 11] if d == 140 else part
        part = [w if k % 6 < 3 else rng.choice(words) for k, w in enumerate(item[:20])] + item[20:40] if d == 141 else part
        body[20:20] = part
        rows.append((d, body))
    want = {(d, i) for d, t in rows for i, item in items if smith_waterman(item, t) >= 0.4 * 2 * len(item)}
    assert len(want) == 122 and {(d, d % 3) for d in range(120)} <= want
    docs = spark.createDataFrame([(d, " ".join(t)) for d, t in rows], "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in items], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(docs, bench).collect()} == want
    assert {r["doc_id"] for r in decontamination.decontaminate(docs, bench).collect()} == {d for d, _ in rows} - {d for d, _ in want}


def test_spread_out_copies_are_found_whole(spark):
    """One word put in after each word but the first three: the alignment spans
    twice the item, and its score is the whole Smith-Waterman score."""
    rng = random.Random(21)
    items = [[f"i{n}w{rng.randrange(10**6)}" for _ in range(n)] for n in (30, 60, 100, 200)]
    texts = []
    for w in items:
        spread = w[:3] + [x for y in w[3:] for x in (y, f"x{rng.randrange(10**6)}")]
        texts.append(" ".join([f"a{rng.randrange(10**6)}" for _ in range(300)] + spread + [f"b{rng.randrange(10**6)}" for _ in range(300)]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in decontamination.leaks(docs, bench).collect()}
    want = {(i, i): smith_waterman(w, texts[i].split()) / (2 * len(w)) for i, w in enumerate(items)}
    assert all(v >= 0.5 for v in want.values()) and got == pytest.approx(want)


def test_random_edits_score_as_brute_force(spark):
    rng = random.Random(22)
    items = [[f"w{rng.randrange(300)}" for _ in range(rng.randrange(8, 50))] for _ in range(25)]
    texts = []
    for w in items * 3:
        copy = []
        for x in w:
            copy += rng.choice([[x]] * 6 + [[], [f"w{rng.randrange(300)}"], [x, f"w{rng.randrange(300)}"]])
        texts.append([f"w{rng.randrange(300)}" for _ in range(60)] + copy + [f"w{rng.randrange(300)}" for _ in range(60)])
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in decontamination.leaks(docs, bench).collect()}
    seeds = [{tuple(w[k:k + 3]) for k in range(len(w) - 2)} for w in items]
    want = {}
    for i, t in enumerate(texts):
        held = {tuple(t[k:k + 3]) for k in range(len(t) - 2)}
        for j, w in enumerate(items):
            if held & seeds[j] and (score := smith_waterman(w, t) / (2 * len(w))) >= 0.4:
                want[i, j] = score
    assert got == pytest.approx(want) and len(want) > 50


def test_a_seed_that_all_items_share():
    """Templated items: a text that repeats their opening is turned away for all of
    them at once, in time that grows with items and places, not their product."""
    import time

    opening, took = "which of the following is".split(), []
    for n in (2000, 8000):
        rows = [(i, " ".join(opening + [f"q{i}x{k}" for k in range(15)])) for i in range(n)]
        items = decontamination._seeded(decontamination._read_items(rows))
        column = decontamination.pa.array([" ".join(opening * (n // 10) + ["end"])])
        batch = decontamination.pa.RecordBatch.from_arrays([column], names=["text"])
        began = time.perf_counter()
        for _, words, at, where in decontamination._texts(batch, 0, items):
            assert decontamination._leaks_of(words, at, where, items, 0.4) == []
        took.append(time.perf_counter() - began)
    assert took[1] < 2


def test_decontamination_query(spark, texts):
    norm = lambda t: b" " + b" ".join(re.findall(rb"[a-z0-9\x80-\xff]+", t.encode().lower())) + b" "
    own = {i: norm(t) for i, t in texts.items()}
    want = {(d, i) for i, t in read("benchmark", "item_id, text") for d, x in own.items() if norm(t) in x}
    assert want <= {(r["doc_id"], r["item_id"]) for r in rows_of(spark, "op1_decontamination")}


def test_mixing_query(spark):
    rows = sorted(tuple(r) for r in rows_of(spark, "op10_mixing"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert rows == sorted(con.execute(entry.oracle_sql()["op10_mixing"]).fetchall())


def test_mixing_keeps_its_limit_in_a_mix_of_any_size(spark):
    rows = [(i, "w " * (1 + i % 3), "abc"[min(i % 10, 2)]) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    tokens = collections.Counter()
    for _, t, src in rows:
        tokens[src] += len(t.split())
    corpus = sum(tokens.values())
    for times, limit in ((0.5, 1.2), (1, 1.2), (3, 3.3), (3, 3.0)):
        out = mixing.mix(docs, target=mixing.Target(max_repetition=limit), total_tokens=int(times * corpus), block_tokens=200).collect()
        drawn = collections.Counter()
        for r in out:
            drawn[r["source"]] += r["n_tokens"]
        assert all(drawn[src] <= limit * tokens[src] + 60 for src in tokens)
        assert abs(sum(drawn.values()) - times * corpus) < 0.05 * corpus + 60
    with pytest.raises(ValueError, match="no exponent"):
        mixing.mix(docs, target=mixing.Target(max_repetition=1.2), total_tokens=3 * corpus)
    flat = mixing.mix(docs, target=mixing.Target(max_repetition=None, entropy=0.6)).first()
    share = [n / corpus for n in tokens.values()]
    weights = [x ** flat["alpha"] for x in share]
    weights = [w / sum(weights) for w in weights]
    assert -sum(w * math.log(w) for w in weights) <= 0.6 * math.log(3) + 1e-4
    with pytest.raises(ValueError, match="no exponent"):
        mixing.mix(docs, target=mixing.Target(max_repetition=None, entropy=0.01))


def test_pipeline_by_stages(spark, texts):
    """Each stage against plain Python on what its predecessor kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r["doc_id"]: r["text"] for r in corpus_pipeline.drop_toxic(spark, docs, SF).collect()}
    toxic = {i for i, t in read("labels", "doc_id, toxic") if t}
    assert len(toxic & set(kept)) <= 0.1 * len(toxic) and len(kept) >= 0.85 * (len(texts) - len(toxic))
    some = spark.createDataFrame(sorted(kept.items()), "doc_id long, text string")
    sets = {i: shingles(t) for i, t in kept.items()}
    want = {i for i, c in components(sets, near_links(sets)).items() if i == c}
    after = {r["doc_id"]: r["text"] for r in corpus_pipeline.drop_near_duplicates(spark, some, SF).collect()}
    assert set(after) == want
    some = spark.createDataFrame(sorted(after.items()), "doc_id long, text string")
    clean = {r["doc_id"]: r["text"] for r in corpus_pipeline.drop_leaks(spark, some, SF).collect()}
    norm = lambda t: b" " + b" ".join(re.findall(rb"[a-z0-9\x80-\xff]+", t.encode().lower())) + b" "
    items = [norm(t) for _, t in read("benchmark", "item_id, text")]
    leaky = {i for i, t in after.items() if any(x in norm(t) for x in items)}
    assert set(clean) & leaky == set() and len(clean) >= len(after) - len(leaky) - 2
    some = spark.createDataFrame(sorted(clean.items()), "doc_id long, text string")
    for r in corpus_pipeline.redact_personal_data(spark, some, SF).collect():
        assert "@mail" not in r["text"] and not re.search(r"\+1 \(\d{3}\) 555", r["text"])
        if not re.search(r"[0-9@]", clean[r["doc_id"]]):
            assert r["text"] == clean[r["doc_id"]]

"""Each operator against a plain version, on small tables with awkward rows."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from safetymart.llm import common, decontaminate, exact_dedup, html_extract, langid, minhash
from safetymart.llm import packing, ppm, sharding, suffix_dedup, warc
from safetymart.llm.components import components

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        *(T.StructField(c, T.StringType()) for c in ("text", "lang", "source")),
        T.StructField("n_chars", T.LongType()),
    ]
)
ODD = [None, "", " \n", "x", "naïve Ωmega 数字", "...", "a\x0bb", "<|endoftext|> it's", "x" * 50_000]


def table(spark, texts, first=0):
    """Documents of these texts; the columns after the id clash with nothing."""
    rows = [(first + i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abcdé"), rng.integers(2, 7))) for _ in range(400)]
    base = [" ".join(rng.choice(words, rng.integers(1, 300))) for _ in range(40)]
    near = [t.replace(t.split()[0], "zz", 1) + " end" for t in base[:15]]
    shared = " ".join(rng.choice(words, 120))
    mixed = [f"{base[i]} {shared} {base[i + 1]}" for i in range(10)]
    return ODD + base + near + base[:8] + [t.upper() for t in base[:3]] + mixed + ODD


def test_exact_groups(spark, texts):
    docs = table(spark, texts).withColumn("digest", F.lit(1))
    got = {r["doc_id"]: r for r in exact_dedup.duplicate_groups(docs).collect()}
    strip = {ord(c): None for c in " \t\n\x0b\x0c\r"}
    contents = [(t or "").translate(strip) for t in texts]
    for i, content in enumerate(contents):
        same = [j for j, c in enumerate(contents) if c == content]
        keep = min(same, key=lambda j: (-len(texts[j] or ""), j))
        sha = hashlib.sha256(content.encode()).hexdigest()
        assert got[i][1:] == (keep, len(same), i == keep, sha)


def test_exact_hot_content_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HOT_ROWS", 5)
    docs = table(spark, ["same text"] * 60 + ["other"] * 3)
    docs = docs.unionByName(docs.filter("doc_id = 0"))
    got = exact_dedup.duplicate_groups(docs).collect()
    assert len(got) == 64 and sum(r["kept"] for r in got) == 2
    assert {r["group_size"] for r in got if r["keep_id"] == 0} == {61}


def test_leaks(spark, texts):
    items = [texts[20], "x", None, "", "naïve ωmega", texts[25], texts[-12]]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = decontaminate.find_leaks(table(spark, texts), bench).collect()
    split = lambda t: decontaminate.words_of((t or "").encode())
    windows = {}
    for i, t in enumerate(items):
        w = split(t)
        for p in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[p : p + 10]), set()).add(i)
    for r in found:
        w, hit, ids = split(r["text"]), set(), set()
        for n in {len(k) for k in windows}:
            for p in range(len(w) - n + 1):
                if tuple(w[p : p + n]) in windows:
                    hit |= set(range(p, p + n))
                    ids |= windows[tuple(w[p : p + n])]
        assert (r["leak"]["n_words"], r["leak"]["n_hit"]) == (len(w), len(hit))
        assert r["leak"]["items"] == sorted(ids)


def test_leaks_in_blocks_are_the_same(spark, texts, monkeypatch):
    bench = spark.createDataFrame(list(enumerate(texts[15:35])), "item_id long, text string")
    whole = decontaminate.find_leaks(table(spark, texts), bench).collect()
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 400)
    found = decontaminate.find_leaks(table(spark, texts), bench)
    assert sorted(found.collect(), key=str) == sorted(whole, key=str)
    # One block's automaton at a time: the last one, over the written pass before.
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    passes = {f.rpartition("/")[0] for f in found.inputFiles()}
    assert len(passes) == 1 and "passed-" in passes.pop()


def test_leaks_are_cut_out(spark):
    passage = "Ten words that no other text than a test holds é!"
    other = "these words are ours and stay where they are in this text of many own words"
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    docs = table(spark, [f"{other} {passage} {other}", passage, None, "", other])
    got = {r["doc_id"]: r["text"] for r in decontaminate.remove_leaks(docs, bench).collect()}
    assert got == {0: f"{other} ! {other}", 2: None, 3: "", 4: other}


def test_shards(spark, texts):
    got = sharding.assign_shards(table(spark, texts * 5), shards=7).collect()
    by_shard = {}
    for r in got:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
        raw = ((texts * 5)[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 16, zlib.crc32(raw))
    sizes = [len(s) for s in by_shard.values()]
    assert len(by_shard) == 7 and max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())


def test_a_group_above_the_quota_is_spread_evenly(spark):
    got = sharding.assign_shards(table(spark, ["same"] * 300 + [str(i) for i in range(60)]), 4)
    assert sorted(r[1] for r in got.groupBy("shard").count().collect()) == [90] * 4


@pytest.mark.parametrize("most", [packing.MAX_FIRSTS, 0])
def test_packing(spark, texts, monkeypatch, most):
    from tokenizers import Tokenizer
    import public_tokenizers

    monkeypatch.setattr(packing, "MAX_FIRSTS", most)  # the tasks' numbers broadcast, and joined
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = packing.pack(table(spark, texts), size=64).collect()
    ids = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for i, t in enumerate(texts)}
    rebuilt, places = {}, {}
    for r in sorted(got, key=lambda r: (r["doc_id"], r["piece"])):
        own = np.frombuffer(r["ids"], np.uint32).tolist()
        assert len(rebuilt.setdefault(r["doc_id"], [])) == r["start"]
        assert len(own) == r["length"] <= 64 and (r["piece"] == 0 or len(own) == 64)
        assert zlib.crc32(r["ids"]) == r["ids_crc32"]
        rebuilt[r["doc_id"]] += own
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert rebuilt == ids
    for runs in places.values():
        runs.sort()
        assert [o for o, _ in runs] == [sum(n for _, n in runs[:i]) for i in range(len(runs))]
        assert sum(n for _, n in runs) <= 64
    least = -(-sum(map(len, ids.values())) // 64)
    assert len(places) <= least + 1


def test_best_two_fit_replaces_the_smallest():
    # Greedy leaves 10 = 6 + 3 with a gap of 1; two pieces of 2 fill it.
    bins = packing.plan_bins({6: 1, 3: 1, 2: 2}, 10)
    assert bins[0] == (1, [(6, 1), (2, 2)])


def repeats(texts, length):
    seen = {}
    raw = [(t or "").encode() for t in texts]
    for b in raw:
        for p in range(len(b) - length + 1):
            seen[b[p : p + length]] = seen.get(b[p : p + length], 0) + 1
    for b in raw:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = True
        yield np.frombuffer(b, np.uint8)[~gone].tobytes()


@pytest.mark.parametrize("most", [20_000, 3])
def test_repeated_strings(spark, texts, monkeypatch, most):
    """Also with keys so large that they are split."""
    monkeypatch.setattr(suffix_dedup, "MOST_ALIKE", most)
    monkeypatch.setattr(suffix_dedup, "COLLECTION", 8)
    own = [t for t in texts if len(t or "") < 40_000] + ["ab" * 700]
    got = {r["doc_id"]: bytes(r["kept"]) for r in suffix_dedup.remove_repeats(table(spark, own)).collect()}
    assert got == dict(enumerate(repeats(own, suffix_dedup.LENGTH)))


def test_repeats_carry_on_shared_keys_only_and_leave_the_marks(spark, monkeypatch, tmp_path):
    """Rows of keys that stand once go no further, and tables go when they were read."""
    kept, keys = common.stored, {}

    def noted(df, label):
        done = kept(df, label)
        if label in ("rows", "contents"):
            keys[label] = Counter(r["key"] for r in done.select("key").collect())
        return done

    monkeypatch.setattr(suffix_dedup, "stored", noted)
    monkeypatch.setattr(common, "scratch_dir", lambda spark, label: f"{tmp_path}/{label}")
    rng = np.random.default_rng(5)
    lone, twice = ("".join(chr(97 + c) for c in rng.integers(0, 26, 3_000)) for _ in range(2))
    own = [lone, f"x{twice}", f"{twice}y", None, "", twice[:399]]
    found = suffix_dedup.remove_repeats(table(spark, own))
    assert [p.name for p in tmp_path.iterdir()] == ["marks"]
    got = {r["doc_id"]: bytes(r["kept"]) for r in found.collect()}
    assert got == dict(enumerate(repeats(own, suffix_dedup.LENGTH)))
    alone = suffix_dedup.anchors(np.frombuffer(lone.encode(), np.uint8), np.zeros(0, np.uint64))[0]
    assert not set(alone.view(np.int64).tolist()) & set(keys["contents"])
    assert min(keys["rows"].values()) > 1


def edited(rng, n):
    """Copies of one text with ever more of its words replaced."""
    base = [f"w{i}" for i in range(150)]
    for i in range(n):
        words = list(base)
        for at in rng.choice(150, i % 12, replace=False):
            words[at] = f"x{rng.integers(5)}"
        yield " ".join(words)


@pytest.mark.parametrize("pairs_per_doc, block_rows", [(0, 4096), (8, 4096), (10**6, 7)])
def test_near_duplicates(spark, texts, monkeypatch, pairs_per_doc, block_rows):
    """By pivots, by whole postings and by postings cut into blocks."""
    monkeypatch.setattr(minhash, "PAIRS_PER_DOC", pairs_per_doc)
    monkeypatch.setattr(minhash, "BLOCK_ROWS", block_rows)
    texts = [*texts, *edited(np.random.default_rng(3), 60)]
    sets = []
    for t in texts:
        w = (t or "").encode().translate(LOWER).split()
        sets.append({tuple(w[k : k + 3]) for k in range(len(w) - 2)} if len(w) > 2 else {tuple(w)} - {()})
    parent = list(range(len(texts)))

    def root(i):
        return i if parent[i] == i else root(parent[i])

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            both = len(a & b)
            if a and b and 100 * both >= 85 * (len(a) + len(b) - both):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    got = {r["doc_id"]: r for r in minhash.near_duplicates(table(spark, texts)).collect()}
    for i, s in enumerate(sets):
        assert got[i][1:] == (len(s), root(i), root(i) == i)


def test_near_duplicates_linked_by_a_row_without_id(spark):
    words = [f"w{i}" for i in range(300)]
    chain = [" ".join(words[k : k + 260]) for k in (0, 15, 30)]
    rows = [(1, chain[0]), (None, chain[1]), (3, chain[2]), (None, "alone as it is"), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in minhash.near_duplicates(docs).collect()}
    assert got == {(1, 258): 1, (None, 258): 1, (3, 258): 1, (None, 2): None, (9, 0): 9}


def test_long_words_with_equal_sums_are_apart(spark):
    """Thue-Morse words, which every polynomial hash modulo 2**64 takes for equal."""
    word = "a"
    while len(word) < 4096:
        word += word.translate({97: 98, 98: 97})
    other = word.translate({97: 98, 98: 97})
    docs = spark.createDataFrame([(1, f"{word} x y"), (2, f"{other} x y"), (3, f"{word.upper()} x y")], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(70, 71)], "a long, b long")
    got = dict(map(tuple, components(edges).collect()))
    assert got == {**{i: 0 for i in range(61)}, 70: 70, 71: 70}


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_records_are_digested_before_they_are_placed(spark):
    """Whole pages move nowhere; records of one page stand by length and digest."""
    rows = [(1, "u", "b" * 9), (1, "u", "a"), (1, "u", "a"), (0, None, None), (None, "u", "c"), (2, "v", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    leaves = warc.record_digests(warc.warc_records(pages))
    plan = leaves._jdf.queryExecution().optimizedPlan().toString()
    above, window, below = plan.partition("Window ")
    assert window and "html" not in above and "sha2(" not in above and "sha2(" in below
    got = sorted(tuple(r) for r in leaves.filter("archive = 0").collect())
    assert [n for _, _, n, _ in got][1] <= [n for _, _, n, _ in got][3]
    assert [at for _, at, _, _ in got] == [sum(r[2] for r in got[:i]) for i in range(5)]
    assert got[1][3] == got[2][3] != got[3][3]


def test_audit_finds_what_differs(spark):
    rows = pages(spark, [(i, f"u{i}", "h" * (i * 37 % 900)) for i in range(2_500)] + [(None, None, None)])
    left = warc.record_digests(warc.warc_records(rows))
    assert warc.audit(left, left).count() == 0
    spot = (F.col("archive") == 1) & (F.col("offset") == left.filter("archive = 1").agg(F.max("offset")).first()[0])
    right = left.withColumn("digest", F.when(spot, "0").otherwise(F.col("digest"))).filter(
        "NOT (archive = 0 AND offset = 0)"
    )
    found = warc.audit(left, right).collect()
    assert sorted((r["archive"], r["status"]) for r in found) == [(0, "missing"), (1, "changed")]
    assert {r["status"] for r in warc.audit(right, left).collect()} == {"added", "changed"}
    assert warc.audit(left.limit(0), left.limit(0)).count() == 0


def test_language(spark):
    rng = np.random.default_rng(3)
    make = lambda letters: " ".join("".join(rng.choice(list(letters), 5)) for _ in range(30))
    rows = [(i, make("abcde" if i % 2 else "vwxyzé"), "l1" if i % 2 else "l2", "s", 0) for i in range(80)]
    odd = [(100 + i, t, None, "s", 0) for i, t in enumerate([None, "", " 12 ²", "数字"])]
    docs = spark.createDataFrame(rows + odd, DOCS)
    model = langid.fit(docs, F.when(F.col("doc_id") >= 20, F.col("lang")))
    got = {r["doc_id"]: r["language"] for r in langid.predict(docs, model).collect()}
    assert all(got[i]["lang_pred"] == ("l1" if i % 2 else "l2") for i in range(80))
    assert [got[i]["lang_pred"] for i in (100, 101, 102)] == ["und"] * 3 and got[103]["lang_pred"] != "und"
    assert all(0 <= r["score"] <= 1 for r in got.values())
    nothing = langid.fit(docs, F.lit(None).cast("string"))
    assert {r["language"]["lang_pred"] for r in langid.predict(docs, nothing).collect()} == {"und"}


def plain_log10(training, text):
    """PPM with method D and exclusion, one symbol after the other."""
    follow = {}
    lead = b"\n" * ppm.ORDER
    for t in training:
        coded = lead + t + b"\n"
        for at in range(ppm.ORDER, len(coded)):
            for k in range(ppm.ORDER + 1):
                follow.setdefault(coded[at - k : at], Counter())[coded[at]] += 1
    coded, total = lead + text + b"\n", 0.0
    for at in range(ppm.ORDER, len(coded)):
        out = set()
        for k in range(ppm.ORDER, -1, -1):
            seen = {s: n for s, n in follow.get(coded[at - k : at], {}).items() if s not in out}
            if not seen:
                continue
            if coded[at] in seen:
                total += np.log10((seen[coded[at]] - 0.5) / sum(seen.values()))
                break
            total += np.log10(len(seen) / 2 / sum(seen.values()))
            out |= set(seen)
        else:
            total -= np.log10(max(1, 256 - len(out)))
    return total


def test_language_model_against_plain(spark):
    texts = ["abra cadabra abra", "Abra  abab", "", None, "abracadab zz", "qq\x00 abrac", "ä ab abr", "abra cadabra abra"]
    docs = table(spark, texts).withColumn("held_out", F.col("doc_id") >= 4)
    coded = [b" ".join((t or "").encode().translate(LOWER).split()) for t in texts]
    for heads in ({}, {"head_words": 2, "head_grams": 5}, {"head_words": 0, "head_grams": 0}):
        got = {r["doc_id"]: r for r in ppm.score_texts(docs, "held_out", **heads).collect()}
        assert len(got) == len(texts)
        for i, t in enumerate(coded):
            assert got[i]["score"] == pytest.approx(plain_log10(coded[:4], t))
    unlearnt = ppm.score_texts(docs.withColumn("held_out", F.lit(True)), "held_out").collect()
    for r in unlearnt:
        size = len(coded[r["doc_id"]]) + 1
        assert r["score"] == pytest.approx(-size * np.log10(256)) and r["train_tokens"] == 0


def test_gram_costs_sum_to_one(spark):
    stream, places, _ = ppm.coded_stream([b"abracadabra", b"abcabcaab"])
    grams = Counter(ppm._grams(stream, places).tolist())
    contexts = (b"\n\n\n\n\n", b"abrac", b"caabc", b"zzzab", b"zzzzz")
    for context in contexts:
        for symbol in range(256):
            grams[int.from_bytes(context + bytes([symbol]), "big")] += 0
    costs = ppm.gram_costs(spark.createDataFrame(list(grams.items()), "code long, n long"))
    sums = costs.groupBy(F.shiftright("code", 8).alias("c")).agg(F.sum(F.pow(F.lit(10.0), "log10")).alias("p"))
    sums = {r["c"]: r["p"] for r in sums.collect()}
    for context in contexts:
        assert sums[int.from_bytes(context, "big")] == pytest.approx(1)


def test_language_model_scores(spark, texts):
    docs = table(spark, texts).withColumn("held_out", F.col("doc_id") % 4 == 0)
    got = {r["doc_id"]: r for r in ppm.score_texts(docs, "held_out").collect()}
    tokens = [(t or "").encode().translate(LOWER).split() + [b""] for t in texts]
    counts = {}
    for i, own in enumerate(tokens):
        for w in own if i % 4 else ():
            counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    for i, own in enumerate(tokens):
        base = sum(np.log10((counts.get(w, 0) + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        assert got[i]["base_score"] == pytest.approx(base) and got[i]["score"] <= 0
        assert got[i]["n_known"] == sum(w in counts for w in own)
        assert (got[i]["n_tokens"], got[i]["train_tokens"]) == (len(own), n)


def test_html(spark):
    body = [f"Paragraph number {i} of this story tells &amp; tells more." for i in range(6)]
    article = "".join(f"<p>{t}" for t in body)
    html = (
        "<html><head><title>T</title><script>var a='<p>no</p>'</script></head><body><nav><ul><li>"
        "<a href=/>Home</a></ul></nav><div class='cookie notice'>We use cookies</div><article>"
        f"{article}</article><section class=comments><p>Nice!</p></section><footer>&copy; x</footer>"
    )
    rows = [(i, "u", html) for i in range(30)] + [(90, "u", None), (91, None, ""), (92, "u", "<p"), (93, "u", "<" * 3000)]
    got = {r["page_id"]: r["main_text"] for r in html_extract.extract_text(pages(spark, rows)).collect()}
    assert got[0] == " ".join(t.replace("&amp;", "&") for t in body)
    assert got[90] == got[91] == ""


def test_labeller_gradients():
    rng = np.random.default_rng(0)
    model = html_extract.Labeller()
    x, lengths = rng.normal(size=(3, 5, html_extract.INPUTS)), np.array([5, 3, 1])
    y = (rng.random((3, 5)) > 0.5).astype(float)
    real = np.arange(5)[None, :] < lengths[:, None]

    def loss():
        p = model.forward(x, lengths)
        return -((y * np.log(p) + (1 - y) * np.log(1 - p)) * real).sum() / real.sum()

    grads = model.gradients(x, lengths, y)
    for name in ("xf", "hb", "cb", "o", "hf"):
        at = tuple(rng.integers(0, n) for n in model.w[name].shape)
        model.w[name][at] += 1e-5
        up = loss()
        model.w[name][at] -= 2e-5
        down = loss()
        model.w[name][at] += 1e-5
        assert grads[name][at] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    bench = spark.createDataFrame([], "item_id long, text string")
    assert exact_dedup.duplicate_groups(docs).count() == 0
    assert decontaminate.find_leaks(docs, bench).count() == 0
    assert sharding.assign_shards(docs).count() == 0
    assert packing.pack(docs).count() == 0
    assert suffix_dedup.remove_repeats(docs).count() == 0
    assert minhash.near_duplicates(docs).count() == 0
    assert langid.predict(docs, langid.fit(docs, F.col("lang"))).count() == 0
    assert ppm.score_texts(docs.withColumn("h", F.lit(False)), "h").count() == 0
    assert html_extract.extract_text(pages(spark, [])).count() == 0


def test_pipeline(spark, texts, tmp_path):
    table(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    bench = spark.createDataFrame([(0, texts[30])], "item_id long, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        if name != "pack":
            assert docs.columns == DOCS.fieldNames()
            left[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(left["language"]) == {i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))}
    contents = ["".join(texts[i].split(" ")) for i in left["exact"]]
    assert len(contents) == len(set(contents))
    assert set(left["near"]) < set(left["exact"])
    assert 30 not in left["decontaminate"] and len(left["decontaminate"]) >= len(left["near"]) - 1
    assert {r["doc_id"] for r in docs.collect()} == set(left["decontaminate"])


def blocks_of(page):
    return [b.text for b in html_extract.page_blocks(page)]


@pytest.mark.parametrize(
    "page, seen",
    [
        ("<head><title>x</title><body><article>A<p>B</article>", ["A", "B"]),
        ("<head><title>x</title><p>A</p><p>B", ["A", "B"]),
        ("<svg a=b /><article>A", ["A"]),
        ("<svg/><p>A</p><svg><text>no</text></svg><p>B", ["A", "B"]),
        ("<svg><svg></svg><title/>no</svg>A", ["A"]),
        ("<title-bar>A</title-bar><select-one>B</select-one>", ["A", "B"]),
        ("<iframe srcdoc='<p>no</p>'></iframe>A<!-- <object> -->B<object>no</object>", ["AB"]),
        *((f"A<{e}><p>B</p><{e} id=x>no</{e}><p>C", ["A", "B", "C"]) for e in html_extract.UNSEEN.split("|")),
        *((f"A<{e}>no</{e} ><p>B<{e}>no<p>no", ["A", "B"]) for e in html_extract.RAW_TEXT.split("|")),
    ],
)
def test_unseen_elements_hide_nothing_else(page, seen):
    assert [t for b in blocks_of(page) for t in b.split()] == seen


def test_html_without_end_tags(spark):
    body = [f"Paragraph number {i} of this story tells and tells more." for i in range(6)]
    article = "".join(f"<p>{t}" for t in body)
    html = f"<html><head><title>T</title><body><nav><svg/><a href=/>Home</a></nav><article>{article}</article>"
    got = html_extract.extract_text(pages(spark, [(i, "u", html) for i in range(30)])).collect()
    assert {r["main_text"] for r in got} == {" ".join(body)}


def test_labeller_learns_from_distinct_pages(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(html_extract, "varied", lambda pages, rng: seen.extend(pages) or [])
    monkeypatch.setattr(html_extract.Labeller, "train", lambda *args: None)
    rows = [(i, "u", f"<p>page {i % 5}") for i in range(500)]
    html_extract.fit(pages(spark, rows), n_pages=4)
    assert len({b[0].text for b in seen}) == len(seen) == 4


def roots(n, linked):
    """Each of ``n`` rows' first row among those it is linked with, over any number of links."""
    parent = list(range(n))

    def root(i):
        return i if parent[i] == i else root(parent[i])

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return [root(i) for i in range(n)]


def plain_stages(rows, items):
    """The rows (id, text) after each stage; ids may be null or used again."""
    yield "language", (rows := [r for r in rows if r[1] and any(map(str.isalpha, r[1]))])
    by_id = lambda r: (r[0] is None, r[0] or 0)
    best = {}
    for r in rows:
        content = r[1].translate({ord(c): None for c in " \t\n\x0b\x0c\r"})
        rank = (-len(r[1]), by_id(r))
        if content not in best or rank < best[content][0]:
            best[content] = (rank, r)
    yield "exact", (rows := [r for _, r in best.values()])
    sets = []
    for _, text in rows:
        w = text.encode().translate(LOWER).split()
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} - {()})
    both = lambda a, b: len(a & b)
    component = roots(
        len(rows),
        lambda i, j: sets[i] and sets[j] and 100 * both(sets[i], sets[j]) >= 80 * len(sets[i] | sets[j]),
    )
    groups = {}
    for r, c in zip(rows, component):
        groups.setdefault(c, []).append(r)
    yield "near", (rows := [min(g, key=by_id) for g in groups.values()])
    words = lambda t: list(re.finditer(rb"[0-9a-z\x80-\xff]+", t.encode().translate(LOWER)))
    windows = set()
    for item in items:
        w = [m[0] for m in words(item)]
        windows |= {tuple(w[p : p + 10]) for p in range(max(1, len(w) - 9))} - {()}
    left = []
    for i, text in rows:
        found, raw, hit = words(text), text.encode(), set()
        w = [m[0] for m in found]
        for n in {len(k) for k in windows}:
            for p in range(len(w) - n + 1):
                hit |= set(range(p, p + n)) if tuple(w[p : p + n]) in windows else set()
        gone = np.zeros(len(raw), bool)
        for h in hit:
            gone[found[h].start() : found[h + 1].start() if h + 1 in hit else found[h].end()] = True
        if 2 * len(hit) <= len(w):
            left.append((i, np.frombuffer(raw, np.uint8)[~gone].tobytes().decode()))
    yield "decontaminate", left


def run_stages(spark, rows, items, tmp_path):
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.stored(stage(spark, docs, str(tmp_path)), name)
        yield name, [(r["doc_id"], r["text"]) for r in docs.collect()]


def same_stages(spark, rows, items, tmp_path):
    for (name, got), (_, want) in zip(run_stages(spark, rows, items, tmp_path), plain_stages(rows, items)):
        assert sorted(got, key=repr) == sorted(want, key=repr), name


def test_pipeline_rows_without_an_id_of_their_own(spark, texts, tmp_path):
    """Null ids, one row twice, one id with two texts of which one is a dropped copy."""
    a, b, c, d, e, f = (texts[len(ODD) + i] for i in range(16, 22))
    rows = [(None, a), (None, b), (None, b), (1, c), (1, c), (2, d), (3, d), (3, e), (None, e), (None, f), (4, f)]
    near_f = f.replace(f.split()[0], "zz", 1) + " end"
    same_stages(spark, [*rows, (None, near_f), (None, None), (5, None)], [texts[-12]], tmp_path)


def test_pipeline_against_plain_stages(spark, texts, tmp_path):
    """Shingles of 5 words, at and around 80 of 100, and spans that are cut."""
    own = [*texts, *edited(np.random.default_rng(4), 60)]
    long = [t for t in texts if t and len(t.split()) > 120]
    own.append(f"{long[0]} {long[-1]} {long[1]}")
    items = [" ".join(long[1].split()[30:50]), texts[30], " ".join(long[-1].split()[:40])]
    same_stages(spark, list(enumerate(own)), items, tmp_path)


def split_groups(docs):
    """How many groups of equal texts are in more than one shard, and the shards' sizes."""
    got = docs.select("doc_id", F.md5("text").alias("key")).join(sharding.assign_shards(docs, 8), "doc_id")
    apart = got.groupBy("key").agg(F.countDistinct("shard").alias("n")).filter("n > 1").count()
    return apart, sorted(r[1] for r in got.groupBy("shard").count().collect())


def test_groups_stay_whole_besides_one_above_the_quota(spark):
    texts = ["large"] * 400 + [f"group {i // 20}" for i in range(720)] + [f"own {i}" for i in range(80)]
    assert split_groups(table(spark, texts)) == (1, [150] * 8)


def test_groups_move_to_most_of_their_members_under_quotas(spark, monkeypatch):
    """Also with running sums over several buckets of a shard's proposals."""
    monkeypatch.setattr(sharding, "GROUP_ROWS", 2)
    placed = {"a": {0: 5, 1: 1}, "b": {0: 1, 1: 3}, "c": {1: 2}, "d": {0: 2, 1: 2}, "e": {2: 9}}
    blocks = [(k, s, n) for k, where in placed.items() for s, n in where.items()]
    groups = [(k, sum(where.values())) for k, where in placed.items()]
    blocks = spark.createDataFrame(blocks, "key string, shard int, n long")
    groups = spark.createDataFrame(groups, "key string, members long")
    settled, room = sharding.propagate(blocks, groups, [7, 8, 4])
    got = {r["key"]: r["shard"] for r in settled.collect()}
    # e fits no shard; c and d are left to the rooms that a and b leave.
    assert (got["a"], got["b"]) == (0, 1) and "e" not in got and set(got) == set("abcd")
    loads = [sum(m for k, m in ((k, sum(w.values())) for k, w in placed.items()) if got.get(k) == s) for s in range(3)]
    assert [r + n for r, n in zip(room, loads)] == [7, 8, 4] and min(room) >= 0


def test_shards_of_null_and_text_ids_and_clashing_columns(spark):
    rows = [(None, "same"), ("x", "same"), ("x", "same"), ("y", None), (None, None), ("z", "")]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    docs = docs.select("*", *(F.lit(1).alias(c) for c in ("key", "shard", "slot", "n", "members")))
    got = sharding.assign_shards(docs, 2).collect()
    assert sorted((r["shard"], r["slot"]) for r in got) == [(s, i) for s in (0, 1) for i in range(3)]
    assert len({r["shard"] for r in got if r["size"] == 20}) == 1


def test_groups_stay_whole_where_quotas_are_full(spark):
    assert split_groups(table(spark, [f"group {i // 20}" for i in range(1600)])) == (0, [200] * 8)


def test_fewer_groups_than_shards_are_split():
    rng = np.random.default_rng(2)
    for _ in range(200):
        shards = int(rng.integers(1, 9))
        sizes = rng.integers(2, rng.choice([4, 40, 400]), int(rng.integers(1, 60)))
        total = int(sizes.sum()) + int(rng.integers(0, 50))
        quota = [total // shards + (s < total % shards) for s in range(shards)]
        classes = {}
        for m in sizes:
            key = (int(m), int(rng.integers(shards)))
            classes[key] = classes.get(key, 0) + 1
        placed, loads = {}, [0] * shards
        for m, label, first, end, s, n in sharding.plan_blocks(classes, quota):
            for rank in range(first, end):
                placed.setdefault((m, label, rank), []).append(n)
                loads[s] += n
        assert sorted(placed) == sorted((*k, r) for k, n in classes.items() for r in range(n))
        assert all(sum(n) == m for (m, _, _), n in placed.items())
        assert all(x <= q for x, q in zip(loads, quota))
        assert sum(len(n) > 1 for (m, _, _), n in placed.items() if m <= quota[0]) < shards

"""Line dedup, n-gram join, packing, BPE, language ID and quality against brute force, round trips and held-out labels."""

import itertools
import random
import re
import sys
import unicodedata
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from leasegrid.llm import bpe, language_id, line_dedup, ngram_join, packing, quality

D = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, component_id string, score string, n_lines int, source string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, "x", "y", 7, s) for i, t, s in rows], SCHEMA).repartition(parts)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empties, ties, repeated rows, near copies, short and long texts; extra columns with clashing names."""
    rng = random.Random(5)
    words = ["alpha", "Beta", "gamma,", "delta", "eps", "zeta", "été", "eta"]
    base = [" ".join(rng.choice(words) + str(rng.randrange(40)) for _ in range(60)) for _ in range(6)]
    rows = [(0, None, None), (1, "", "a"), (2, " \t\n", "a"), (3, "one two", "b"), (4, "ONE  two", "b"), (None, "one two", None), (5, "\x1cx y", "a")]
    rows += [(None, base[0], "a")]
    at = 10
    for b in base:
        for _ in range(8):
            w = b.split()
            for _ in range(rng.randrange(4)):
                w[rng.randrange(len(w))] = "new%d" % rng.randrange(9)
            rows.append((at, (" " if at % 3 else "\n").join(w), "src%d" % (at % 2)))
            at += 1
    line = "A line that many documents share."
    rows += [(100 + i, f"{'own %d' % i}\n {line} \nshort", "hot") for i in range(400)]
    rows += [(100, f"{'own %d' % 0}\n {line} \nshort", "hot")] * 3
    rows += [(600, "long " * 30_000, "a"), (601, base[1], "a"), (602, base[1], "a")]
    return rows


def sets_of(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def components(rows, percent=80):
    docs = [(i, sets_of(t)) for i, t in rows if i is not None]
    up = {i: i for i, _ in docs}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for (i, a), (j, b) in itertools.combinations(docs, 2):
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            x, y = find(i), find(j)
            up[max(x, y)] = min(x, y)
    return sorted((str(i), len(sets_of(t)), None if i is None else find(i)) for i, t in rows)


@pytest.mark.parametrize("block", [512, 2])
def test_ngram_join_equals_brute_force(spark, odd, block, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    # With small blocks, also with most n-grams counted as frequent.
    got = ngram_join.jaccard_components(frame(spark, odd), share=2000 if block > 2 else 60).collect()
    assert sorted((str(r[0]), r[1], r[2]) for r in got) == components([r[:2] for r in odd])


def test_ngram_join_of_an_empty_table(spark):
    assert ngram_join.jaccard_components(frame(spark, [(1, None, "a")]).limit(0)).count() == 0
    assert ngram_join.jaccard_components(frame(spark, [(1, None, "a"), (2, "", "b")])).orderBy("doc_id").collect() == [(1, 0, 1), (2, 0, 2)]


def tiles_of(rng, keys, lone):
    """Rows (key, band, x, y, set, n, comp, side, bits) of small tiles over near copies of unlike sizes, sorted by tile."""
    held = []
    for _ in range(60):
        base = [rng.getrandbits(64) for _ in range(rng.choice([1, 3, 20, 63, 64, 65, 70, 130, 300]))]
        for _ in range(5):
            s = np.unique(np.array([rng.getrandbits(64) if rng.random() < 0.06 else x for x in base], np.uint64))
            held.append((rng.getrandbits(62) - 2**61, len(s), rng.randrange(5), ngram_join.parity_bits(s).tobytes()))
    rows = []
    for k in range(keys):
        at = rng.randrange(len(held) - 8)
        for i, n, comp, bits in rng.sample(held[at : at + 8], rng.randrange(2, 5)):
            rows += [(k // 2, k % 2, 0, 0, i, n, comp, side, bits) for side in ([2] if lone(k) else rng.choice([[0], [1], [0, 1]]))]
    return rows


def tile_batches(rows):
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    names = ["key", "band", "x", "y", "set", "n", "comp", "side", "bits"]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names).to_batches(max_chunksize=997)


@pytest.mark.parametrize("nearest", [None, 1, 2])
@pytest.mark.parametrize("most", [1, 1 << 18])
def test_ngram_tiles_give_the_pairs_of_each_tile(nearest, most, monkeypatch):
    monkeypatch.setattr(ngram_join, "PAIRS", most, raising=False)
    rows = tiles_of(random.Random(3), 900, lambda k: k % 3 > 0)
    want = set()
    for _, tile in itertools.groupby(rows, key=lambda r: r[:4]):
        tile = list(tile)
        for _, _, _, _, a, na, ca, sa, x in tile:
            near = []
            for _, _, _, _, b, nb, cb, sb, y in tile:
                low = min(len(x), len(y))
                fold = lambda z, low=low: z if len(z) == low else bytes(p ^ q for p, q in zip(z[:low], z[low:], strict=True))
                if sa != 1 and sb != 0 and ca != cb and (na, a) < (nb, b) and 100 * na >= 80 * nb:
                    differ = (int.from_bytes(fold(x)) ^ int.from_bytes(fold(y))).bit_count()
                    if 180 * ((na + nb - differ) // 2) >= 80 * (na + nb):
                        near.append((differ, b))
            want |= {(min(a, b), max(a, b)) for _, b in sorted(near)[:nearest]}
    got = [p for out in ngram_join._tiled(80, nearest)(iter(tile_batches(rows))) for p in zip(*(c.to_pylist() for c in out.columns), strict=True)]
    assert set(got) == want and len(want) > 50


def test_ngram_tiles_are_not_compared_one_by_one():
    """Most keys are held by two or three sets: a call for each of their tiles would cost more than all comparisons."""
    rows, calls = tiles_of(random.Random(4), 6000, lambda k: True), [0]

    def count(frame, event, arg):
        calls[0] += event == "call"

    batches = tile_batches(rows)
    sys.setprofile(count)
    try:
        for _ in ngram_join._tiled(80, 3)(iter(batches)):
            pass
    finally:
        sys.setprofile(None)
    assert calls[0] < 3000


def lines_by_force(rows):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    held = defaultdict(set)
    least = lambda i: -1 if i is None else i
    for i, t, _ in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 20:
                held[key(x)].add(least(i))
    out = []
    for i, t, _ in rows:
        all_ = (t or "").split("\n")
        keep = [x for x in all_ if len(key(x)) < 20 or len(held[key(x)]) < 3 or max(held[key(x)]) == least(i)]
        out.append((str(i), len(all_), len(all_) - len(keep), "\n".join(keep)))
    return sorted(out)


@pytest.mark.parametrize("parts", ["2", "13"])
def test_line_dedup_equals_brute_force_with_a_line_over_many_partitions(spark, odd, parts):
    was = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = line_dedup.dedup_lines(frame(spark, odd)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", was[1])
    assert sorted((str(r[0]), r[1], r[2], r[3]) for r in got) == lines_by_force(odd)


def test_line_dedup_of_an_empty_table(spark):
    assert line_dedup.dedup_lines(frame(spark, [(1, None, "a")]).limit(0)).count() == 0


def test_bitmaps_are_compressed_and_small(spark, odd):
    got = line_dedup.keep_bitmaps(frame(spark, odd)).where("doc = 101").first()
    assert got["n_lines"] == 3 and got["n_dropped"] == 1
    assert np.unpackbits(np.frombuffer(zlib.decompress(got["keep_bitmap"]), np.uint8), count=3).tolist() == [1, 0, 1]


@pytest.mark.parametrize("copies", [4096, 2])
def test_packing_keeps_everything_and_every_rule(spark, odd, copies, monkeypatch):
    monkeypatch.setattr(packing, "COPIES", copies)
    capacity, slots = 500, 2
    rows = odd + [(700, "é漢🙂" * 400, "a"), (701, "x" * 500, "a"), (702, "x" * 1000, "b"), (703, "é" * 500, None), (704, "é" * 500, None)]
    got = packing.pack(frame(spark, rows), capacity, slots=slots, shard_rows=64).collect()
    texts = {i: (t or "").encode() for i, t, _ in rows if i is not None}
    size = defaultdict(int)
    for r in got:
        size[r["doc_id"]] += r["size"]
        if r["doc_id"] in texts:
            piece = texts[r["doc_id"]][r["start"] : r["start"] + r["size"]]
            assert len(piece) == r["size"] and piece.decode() is not None
            assert (r["bin"] is None) == (r["at"] is None) == (not texts[r["doc_id"]])
        assert r["bin"] is None or 0 < r["size"] <= r["at"] + r["size"] <= capacity
        assert r["bin"] is None or r["bin"] >= 0 or r["size"] > capacity - 4
    want = defaultdict(int)
    for i, t, _ in rows:
        want[i] += len((t or "").encode())
    assert size == want
    assert sorted(r["size"] for r in got if r["doc_id"] == 702) == [500, 500] and [r["size"] for r in got if r["doc_id"] == 701] == [500]
    source, text = {i: s for i, _, s in rows}, {i: (t or "").strip(" ").lower() for i, t, _ in rows}
    bins = defaultdict(list)
    for r in got:
        if (r["bin"] or 0) >= 0 and r["bin"] is not None:
            bins[r["shard"], r["bin"]].append(r)
    for held in bins.values():
        spans = sorted((r["at"], r["at"] + r["size"]) for r in held)
        assert all(a[1] <= b[0] for a, b in itertools.pairwise(spans))
        ids = [r["doc_id"] for r in held if r["doc_id"] is not None]
        assert len({text[i] for i in ids}) == len(ids)
        by = defaultdict(int)
        for i in ids:
            by[source[i]] += 1
        assert max(by.values(), default=0) <= slots
    # Another layout of the same rows gives the same bins.
    again = packing.pack(frame(spark, rows[::-1], 7), capacity, slots=slots, shard_rows=64).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, got), key=repr)
    assert packing.pack(frame(spark, rows).limit(0), capacity).count() == 0


def test_best_fit_equals_a_plain_search():
    rng = random.Random(2)
    for _ in range(60):
        items = [(rng.randrange(0, 30), rng.choice("abcd"), rng.choice([None, 1, 2, 3])) for _ in range(40)]
        free, held, want = [], [], [None] * len(items)
        for i in sorted(range(len(items)), key=lambda i: (-items[i][0], i)):
            n, s, c = items[i]
            ok = [b for b in range(len(free)) if free[b] >= n and ("s", s) not in held[b] and (c is None or ("c", c) not in held[b])]
            b = min(ok, key=lambda b: (free[b], b), default=None)
            if b is None:
                b = len(free)
                free.append(40)
                held.append(set())
            want[i] = (b, 40 - free[b])
            free[b] -= n
            held[b] |= {("s", s)} | ({("c", c)} if c is not None else set())
        assert packing.best_fit(items, 40) == want


@pytest.fixture(scope="module")
def coders():
    import public_tokenizers as p
    import tiktoken

    path = p.path("byte_bpe_multi_50k.tiktoken")
    ranks = bpe.read_ranks(path)
    return bpe.PrefixCoder(ranks, p.PATTERN), tiktoken.Encoding("own", pat_str=p.PATTERN, mergeable_ranks=ranks, special_tokens={}), path, p.PATTERN


ALPHABET = "abcdehinortsu  \n\n\tÉèñßüABC019.,!?#$%'漢字日本привет🙂🏽 　"


def test_bpe_encodes_as_the_public_library(coders):
    own, public, _, _ = coders
    rng = random.Random(1)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(60))) for _ in range(1500)] + ["a" * 3000, " " * 400 + "x", "ab" * 900, "", None]
    for text, ids in zip(texts, own.encode_all(texts), strict=True):
        assert ids.tolist() == public.encode_ordinary(text or "") == own.encode(text)
    assert own.decode_all(own.encode_all(texts)) == [(t or "").encode() for t in texts]


def test_bpe_edits_and_appends_equal_encoding_anew(coders):
    own, public, _, _ = coders
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choice(ALPHABET) for _ in range(rng.randrange(40)))
        opened = own.open(text)
        for _ in range(4):
            at = rng.randrange(len(text) + 1)
            cut = rng.randrange(0, min(6, len(text) - at) + 1)
            put = "".join(rng.choice(ALPHABET) for _ in range(rng.randrange(6)))
            opened.edit(at, cut, put)
            text = text[:at] + put + text[at + cut :]
            assert opened.text == text and opened.ids() == public.encode_ordinary(text)


def test_bpe_round_trip_on_a_table(spark, odd, coders):
    own, public, path, pattern = coders
    got = bpe.round_trip(frame(spark, odd), path, pattern).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"], bytes(r["bytes"])) for r in got) == sorted((str(i), len(public.encode_ordinary(t or "")), (t or "").encode()) for i, t, _ in odd)
    again = bpe.decode(bpe.encode(frame(spark, odd), path, pattern), path, pattern)
    assert again.count() == len(odd)
    assert bpe.round_trip(frame(spark, odd).limit(0), path, pattern).count() == 0


def test_language_id_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = language_id.fit(docs.where(~held))
    got = language_id.identify(docs, model, carry=("lang",)).where(held)
    assert got.where("lang = lang_pred").count() / got.count() >= 0.97
    made = spark.createDataFrame([(1, None), (2, ""), (3, "12 !! 34"), (4, "Привет мир"), (5, "the and of that in it was with " * 9 + "der die und ist nicht mit sich auf " * 9)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in language_id.identify(made, model).collect()}
    assert [rows[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and rows[1]["score"] == 0
    assert 0 < rows[4]["score"] <= 1
    assert [s["lang"] for s in rows[5]["spans"]] == ["en", "de"] and rows[5]["spans"][0]["last"] == 71
    assert language_id.identify(made.limit(0), model).count() == 0
    assert language_id.identify(made, language_id.fit(docs.limit(0))).where("lang_pred = 'und'").count() == 5


def test_viterbi_equals_all_paths():
    rng = np.random.default_rng(4)
    model = language_id.LanguageModel(["a", "b", "c"], np.zeros((1, 3)), np.ones((1, 3), bool), switch=1.5)
    for n in (1, 2, 3, 5, 7):
        scores = rng.normal(size=(n, 3)) * 2
        label = model.paths(scores, np.array([0, n]))
        value = lambda path: sum(scores[i, k] for i, k in enumerate(path)) - 1.5 * sum(a != b for a, b in itertools.pairwise(path))
        assert value(label.tolist()) == pytest.approx(max(map(value, itertools.product(range(3), repeat=n))))


def test_viterbi_where_the_best_single_language_is_a_compromise():
    rng = np.random.default_rng(11)
    model = language_id.LanguageModel(["a", "b", "c"], np.zeros((1, 3)), np.ones((1, 3), bool), switch=1.5)
    value = lambda scores, path: sum(scores[i, k] for i, k in enumerate(path)) - 1.5 * sum(a != b for a, b in itertools.pairwise(path))
    case = np.array([[0.0, 1.0, -10.0], [0.0, -10.0, 1.0]])
    assert model.paths(case, np.array([0, 2])).tolist() == [1, 2]
    for n in (2, 3, 4, 5) * 40:
        scores = rng.normal(size=(n, 3)) * rng.choice([0.5, 1, 3])
        scores[:, 0] = rng.normal(size=n) * 0.2
        label = model.paths(scores, np.array([0, n]))
        assert value(scores, label.tolist()) == pytest.approx(max(value(scores, p) for p in itertools.product(range(3), repeat=n)))


def test_quality_on_held_out_labels(spark):
    docs, labels = spark.read.parquet(f"{D}/documents.parquet"), spark.read.parquet(f"{D}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = quality.fit(docs, labels.where(~held))
    got = quality.score(docs, model).join(labels, "doc_id").where(held)
    assert got.where((F.col("score") >= 0.3) == (F.col("quality") == 1)).count() / got.count() >= 0.95
    odd = spark.createDataFrame([(1, None), (2, ""), (None, "x")], "doc_id long, text string")
    assert quality.score(odd, model).where("score between 0 and 1").count() == 3
    assert quality.score(odd.limit(0), model).count() == 0
    assert {r["score"] for r in quality.score(odd, quality.fit(docs, labels.limit(0))).collect()} == {1.0}


def language_by_force(model, text):
    """lang_pred and score of a whole text: trigrams word by word, every word's candidates by script, and a plain dynamic program."""
    rows, letters = [], []
    for word in (text or "").split():
        word = word.lower()
        is_letter = [unicodedata.category(c)[0] == "L" for c in word]
        first = next((c for c, ok in zip(word, is_letter, strict=True) if ok), None)
        script = next((k for k, (_, ranges) in enumerate(language_id.SCRIPTS) if first and any(a <= ord(first) <= b for a, b in ranges)), language_id.OTHER)
        own = [0.0] * len(model.langs)
        code = [0, *(ord(c) if ok else 0 for c, ok in zip(word, is_letter, strict=True)), 0]
        for i, ok in enumerate(is_letter, 1):
            if ok:
                b = ((code[i - 1] * 1_000_003 + code[i]) * 998_244_353 + code[i + 1]) * 11_400_714_819_323_198
                b = ((b + 2**63) % 2**64 - 2**63 >> 20) % language_id.BINS
                own = [x + model.logp[b, k] for k, x in enumerate(own)]
        rows.append([x if first is None or model.allowed[script, k] else -np.inf for k, x in enumerate(own)])
        letters.append(sum(is_letter))
    if not sum(letters):
        return "und", 0.0
    value, back = rows[0], []
    for row in rows[1:]:
        top = int(np.argmax(value))
        back.append([k if value[k] >= value[top] - model.switch else top for k in range(len(row))])
        value = [max(value[k], value[top] - model.switch) + x for k, x in enumerate(row)]
    at = int(np.argmax(value))
    path = [at]
    for b in reversed(back):
        at = b[at]
        path.append(at)
    mass = np.bincount(path[::-1], weights=letters, minlength=len(model.langs))
    return model.langs[int(mass.argmax())], mass.max() / sum(letters)


def test_language_id_of_whole_texts_equals_brute_force(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    model = language_id.fit(docs, sample=300)
    some = [r["text"] for r in docs.orderBy("doc_id").limit(60).collect()]
    rng = random.Random(2)
    mixed = [" ".join(" ".join(rng.choice(some).split()[:12]) for _ in range(4)) for _ in range(30)]
    odd = [None, "", "12 \t 7", "a\x00b the und\x00 \x00", "\x00", "Привет the мир", "\u3000x\u00a0y", "漢字 und the 🙂 𝒜bc", "the " * 50_000 + "und " * 20_000, *["ties ties"] * 3]
    texts = some + mixed + odd
    rows = [(i, t, "x", 1.5) for i, t in enumerate(texts)] + [(None, "the", None, None)]
    frame_ = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string, spans double").repartition(2)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify(frame_, model).collect()}
    for i, t, *_ in rows:
        lang, score = language_by_force(model, t)
        assert got[i] == (lang, pytest.approx(score)), t
    with pytest.raises(ValueError, match="carry"):
        language_id.identify(frame_, model, carry=("spans",))


def test_viterbi_shuts_out_languages_of_another_script():
    bins = np.zeros((language_id.BINS, 2))
    allowed = np.ones((language_id.OTHER + 1, 2), bool)
    # The first language doesn't use Cyrillic, the second not Latin; the first likes every trigram better.
    allowed[2], allowed[0] = [False, True], [True, False]
    bins[:, 1] = -5.0
    model = language_id.LanguageModel(["a", "b"], bins, allowed)
    words = pa.array(["one", "два", "три", "12", "two"])
    scores, count = model.word_scores(words)
    assert count.tolist() == [3, 3, 3, 0, 3]
    assert model.paths(scores, np.array([0, 5])).tolist() in ([0, 1, 1, 1, 0], [0, 1, 1, 0, 0])


def test_quality_equals_a_plain_vote_and_is_not_moved_by_other_texts(spark):
    docs, labels = spark.read.parquet(f"{D}/documents.parquet"), spark.read.parquet(f"{D}/labels.parquet")
    model = quality.fit(docs, labels, sample=400)
    texts = [r["text"] for r in docs.orderBy("doc_id").limit(120).collect()]
    odd = ["nul\x00in \x00 the\x00", "\x00", None, "", "  lead", "x " * 40_000, *["a tie"] * 3]
    rows = [(i, t, 0.5, "k") for i, t in enumerate(texts + odd)] + [(None, "x", None, None), (0, texts[0], 0.5, "k")]
    frame_ = spark.createDataFrame(rows, "doc_id long, text string, score double, _text string").repartition(3)
    got = sorted(((r["doc_id"] if r["doc_id"] is not None else -1, r["score"]) for r in quality.score(frame_, model).collect()))
    want = []
    for i, t, *_ in rows:
        # One text at a time, against one labelled vector at a time.
        x = model.latent(quality.bags(pa.array([t], pa.string()), model.vocabulary))[0]
        like = [round(sum(a * b for a, b in zip(x, v, strict=True)), 9) for v in model.vectors.tolist()]
        near = sorted(range(len(like)), key=lambda j: (-like[j], j))[: model.k]
        weight = [max(like[j], 1e-3) ** quality.POWER for j in near]
        want.append((-1 if i is None else i, sum(w * model.labels[j] for w, j in zip(weight, near, strict=True)) / sum(weight)))
    assert [i for i, _ in got] == [i for i, _ in sorted(want)]
    assert [s for _, s in got] == pytest.approx([s for _, s in sorted(want)], abs=1e-6)
    without = {r["doc_id"]: r["score"] for r in quality.score(frame_.where("doc_id < 120"), model).collect()}
    assert without == {i: s for i, s in got if 0 <= i < 120}


def test_quality_by_words_alone(spark):
    """Sentences of one shape that differ only in which words they hold."""
    rng = random.Random(9)
    words = {1: ["river", "stone", "cloud", "field", "north", "light", "table", "piano"], 0: ["bonus", "prize", "cheap", "click", "offer", "lucky", "sales", "promo"]}
    rows = [(i, " ".join(rng.choice(words[i % 2]) for _ in range(30)).capitalize() + ".", i % 2) for i in range(400)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    model = quality.fit(docs, spark.createDataFrame([(r[0], r[2]) for r in rows[:300]], "doc_id long, quality int"))
    got = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    assert sum((got[i] >= 0.5) == (y == 1) for i, _, y in rows[300:]) >= 95


def test_pipeline_stages_against_brute_force(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plain = lambda df: {r["doc_id"]: r["text"] for r in df.collect()}
    steps = [plain(docs)]
    for _, stage in pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf).collect(), docs.schema)
        assert docs.columns == pipeline.COLUMNS
        steps.append(plain(docs))
    raw, lid, good, lines, joined = steps
    assert set(joined) <= set(lines) == set(good) <= set(lid) <= set(raw)
    want = {int(i): t for i, _, _, t in lines_by_force([(i, t, None) for i, t in good.items()])}
    assert lines == want
    assert set(joined) == {int(i) for i, _, c in components(list(lines.items())) if int(i) == c}
    packed = pipeline.run(spark, sf).groupBy("doc_id").agg(F.sum("size").alias("n")).collect()
    assert {r["doc_id"]: r["n"] for r in packed} == {i: len(t.encode()) for i, t in joined.items()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    clean = [i for i in lid if labels.get(i) == 1]
    assert sum(i in good for i in clean) >= 0.98 * len(clean)


def test_pipeline_on_odd_and_empty_tables(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    d = "/root/testdata/sf0.001"
    some = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select(*pipeline.COLUMNS).orderBy("doc_id").limit(80).collect()]
    base = some[0][1]
    rows = some + some[:3] + [(None, base, None, None, None), (900, None, "en", "a", None), (901, "", "en", None, 0), (902, "12 \x00 34", None, "a", 7), (903, base + "\x00", "en", "a", 9), (904, "word " * 60_000, "en", "a", 1), (905, "漢字 und the 🙂", None, "", 2)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, lang_pred int, bin string, run int, component_id string, _text string"
    spark.createDataFrame([(*r, "s", 1, "b", 2, "c", "t") for r in rows], schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{d}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, str(tmp_path)).collect(), docs.select(*pipeline.COLUMNS).schema)
        assert docs.columns == pipeline.COLUMNS
    kept = docs.collect()
    assert not {r["doc_id"] for r in kept} & {900, 901, 902} and all(r["text"] is not None for r in kept)
    got = pipeline.run(spark, str(tmp_path)).groupBy("doc_id").agg(F.sum("size").alias("n")).collect()
    want = defaultdict(int)
    for r in kept:
        want[r["doc_id"]] += len(r["text"].encode())
    assert {r["doc_id"]: r["n"] for r in got} == want
    spark.read.parquet(f"{tmp_path}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.read.parquet(f"{d}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/none/labels.parquet")
    assert pipeline.run(spark, f"{tmp_path}/none").count() == 0

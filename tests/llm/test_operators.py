"""Every operator against brute force on small inputs with nulls, repeats, ties and long texts."""

import base64
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusloom.llm import base, bpe, chat, exact, language, licenses, neighbours, packing, quotient, simhash, tokenfile, toxicity
from corpusloom.llm import queries as Q

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

PROSE = "the quick brown fox jumps over the lazy dog while seven small birds sing in the old green tree by the river"
TEXTS = [
    None, "", "  ", "a", "A b\tC", "a bc", "ab c", "a b c ", "x" * 5000, "1 2 3 !", "😀 é́ 中文 <|endoftext|> it's",
    PROSE, PROSE, PROSE.upper(), PROSE + " again", " ".join([PROSE] * 30), " ".join([PROSE] * 30) + " end", "\n\n", "one\n\ntwo",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 3 else None, "s", 0) for i, t in enumerate(TEXTS)]
    rows += [(3, "a", "en", "s", 0), (None, "null id", None, None, None), (11, PROSE, "en", "s", 0)]
    # columns whose names the operators use inside
    frame = spark.createDataFrame(rows, SCHEMA)
    return frame.withColumns({c: F.lit("x") for c in ("fp", "start", "length", "score", "n", "keep_id", "ids", "kept")})


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def texts_of(docs):
    return [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]


def test_quotient_filter_round_trip_and_merge():
    rng = np.random.default_rng(0)
    for n, bits in ((0, 20), (1, 20), (5, 4), (16, 4), (3000, 61), (3000, 13)):
        sides = []
        for _ in range(2):
            raw = rng.integers(0, 1 << bits, n, dtype=np.uint64)
            values, counts = quotient.combined(raw, rng.integers(1, 9, n))
            made = quotient.QuotientFilter.of(values, counts, bits)
            made = quotient.QuotientFilter.from_bytes(made.to_bytes())
            assert [x.tolist() for x in made.entries()] == [values.tolist(), counts.tolist()]
            sides.append((made, values, counts))
        (a, v, c), (b, w, d) = sides
        want = quotient.combined(np.r_[v, w], np.r_[c, d])
        assert [x.tolist() for x in a.merge(b).entries()] == [x.tolist() for x in want]


def test_exact_groups(docs, empty):
    got = sorted((tuple(r) for r in exact.exact_groups(docs).drop("n_chars").collect()), key=repr)
    rows = [(d, len(t), re.sub("[\x20\x09-\x0d]", "", t)) for d, t in texts_of(docs)]
    want, once = [], set()
    for d, n, norm in rows:
        group = [r for r in rows if r[2] == norm]
        best = min(group, key=lambda r: (-r[1], r[0] is None, r[0] or 0))
        kept = (d, n) == best[:2] and (d, norm) not in once
        if kept:
            once.add((d, norm))
        want.append((d, best[0], len(group), kept, hashlib.sha256(norm.encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    assert exact.exact_groups(empty).count() == 0
    stay = exact.without_exact_copies(docs)
    assert stay.columns == docs.columns
    assert stay.count() == sum(w[3] for w in want)


def plain_fingerprint(text, words=4):
    tokens = re.sub(r"[A-Z]", lambda m: m[0].lower(), text)
    tokens = re.findall("[^\x20\x09-\x0d]+", tokens)
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_classes(fps):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in fps:
        for b in fps:
            if (a ^ b).bit_count() <= 4:
                root[find(a)] = find(b)
    return {f: find(f) for f in fps}


def test_simhash(docs, empty):
    rows = [(d, plain_fingerprint(t)) for d, t in texts_of(docs)]
    classes = plain_classes({f for _, f in rows})
    least = {}
    for d, f in rows:
        if d is not None:
            least[classes[f]] = min(least.get(classes[f], d), d)
    want = sorted(((d, f, least.get(classes[f])) for d, f in rows), key=repr)
    got = [(r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in simhash.simhash_groups(docs).collect()]
    assert sorted(got, key=repr) == want
    assert simhash.simhash_groups(empty).count() == 0
    stay = sorted(r["doc_id"] for r in simhash.without_near_copies(docs).where("doc_id is not null").collect())
    assert stay == sorted(set(least.values()))


def test_triples_meet_every_four_positions():
    from itertools import combinations

    assert len(simhash.triples()) == 20
    assert all(any(set(t) <= set(q) for t in simhash.triples()) for q in combinations(range(8), 4))


@pytest.mark.parametrize("limit", [4096, 1])
def test_links_keep_every_class(spark, monkeypatch, limit):
    """Chains and balls of near fingerprints, with lists compared in tasks or by midpoints."""
    monkeypatch.setattr(simhash, "LIST", limit)
    rng = random.Random(limit)
    fps = {rng.getrandbits(64) for _ in range(30)}
    for base_fp in list(fps)[:6]:
        for _ in range(6):
            for bit in rng.sample(range(64), rng.randint(1, 5)):
                base_fp ^= 1 << bit
            fps.add(base_fp)
    signed = [(f - 2**64 if f >= 2**63 else f,) for f in fps]
    roots = base.components(simhash.links(spark.createDataFrame(signed, "fp long"))).collect()
    found = {r["node"] % 2**64: r["root"] for r in roots}
    want = plain_classes(fps)
    groups = {}
    for f in fps:
        groups.setdefault(want[f], set()).add(f)
    for members in groups.values():
        assert len({found.get(f, f) for f in members}) == 1
    assert len({found.get(f, f - 2**64 if f >= 2**63 else f) for f in fps}) == len(groups)


def encoded(path, text):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return [*tokenizer.encode(text, add_special_tokens=False).ids, 0]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files(spark, docs, empty, monkeypatch, tmp_path):
    monkeypatch.setattr(tokenfile, "FRAME", 64)
    manifest = tokenfile.write_ids(docs, BYTE)
    rows = sorted(texts_of(docs), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want, start = [], 0
    for d, t in rows:
        ids = encoded(BYTE, t)
        want.append((d, start, len(ids), crc(ids)))
        start += len(ids)
    got = [tuple(r) for r in tokenfile.with_checksums(tokenfile.read_ids(manifest)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    some = tokenfile.read_ids(manifest, [8, 15]).collect()
    assert sorted((r["doc_id"], len(r["ids"])) for r in some) == sorted((w[0], w[2]) for w in want if w[0] in (8, 15))
    assert tokenfile.read_ids(tokenfile.write_ids(empty, BYTE)).count() == 0


def test_reader_takes_only_the_frames_of_a_document_and_checks_them(tmp_path):
    import zstandard
    from pyarrow import fs

    store, path = fs.LocalFileSystem(), str(tmp_path / "ids.zst")
    lists = [np.arange(n, dtype=np.uint32) for n in (5, 200_000, 0, 7)]
    with store.open_output_stream(path, compression=None) as out:
        writer = tokenfile.Writer(out)
        for i, ids in enumerate(lists):
            writer.add(i * 10, ids)
        writer.close()
    raw = zstandard.ZstdDecompressor().stream_reader(open(path, "rb"), read_across_frames=True).read()
    assert raw == np.concatenate(lists).astype("<u4").tobytes()
    with store.open_input_file(path) as source:
        reader = tokenfile.Reader(source)
        assert [(d, ids.tolist()) for d, _, ids in reader.documents({0, 30})] == [(0, lists[0].tolist()), (30, lists[3].tolist())]
        assert reader.frames_read == 2 and len(reader.table) == 4
    data = bytearray(open(path, "rb").read())
    data[20] ^= 255
    open(path, "wb").write(data)
    with store.open_input_file(path) as source, pytest.raises((ValueError, zstandard.ZstdError)):
        list(tokenfile.Reader(source).documents())


def test_packing(docs, empty):
    placed = packing.packed(docs, WORD, capacity=64)
    rows = placed.collect()
    want = []
    for d, t in texts_of(docs):
        ids = encoded(WORD, t)
        want += [(d, i, at, len(ids[at : at + 64]), crc(ids[at : at + 64])) for i, at in enumerate(range(0, len(ids), 64))]
    key = lambda r: (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
    assert sorted(map(key, rows), key=repr) == sorted(want, key=repr)
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 64
    assert len(bins) == -(-sum(w[3] for w in want) // 64)
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(placed, docs, WORD, capacity=64).collect()}
    for r in rows:
        assert crc(whole[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]]) == r["ids_crc32"]
    assert packing.packed(empty, WORD).count() == 0


def test_fullest_is_the_best_subset_sum():
    rng = random.Random(4)
    for _ in range(200):
        counts = {rng.randint(1, 30): rng.randint(1, 3) for _ in range(rng.randint(1, 6))}
        room = rng.randint(0, 60)
        sums = {0}
        for n, c in counts.items():
            sums = {s + n * k for s in sums for k in range(c + 1)}
        chosen = packing.fullest(counts, sorted(counts, reverse=True), room)
        assert sum(chosen) == max(s for s in sums if s <= room)
        assert all(chosen.count(n) <= counts[n] for n in chosen)


def test_byte_bpe(docs, empty):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for most in (1 << 20, 0):
        ids = bpe.encoded(docs, RANKS, public_tokenizers.PATTERN, most)
        got = bpe.decoded(ids.withColumn("kept", F.col("ids")), RANKS).collect()
        want = [(d, library.encode_ordinary(t), t.encode()) for d, t in texts_of(docs)]
        assert sorted(((r["doc_id"], r["kept"], bytes(r["bytes"])) for r in got), key=repr) == sorted(want, key=repr)
        both = bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN, most).collect()
        want = [(d, len(i), ",".join(map(str, i)), t) for d, i, t in want]
        assert sorted(((r["doc_id"], r["n_tokens"], r["ids"], bytes(r["bytes"])) for r in both), key=repr) == sorted(want, key=repr)
    assert bpe.encoded(empty, RANKS, public_tokenizers.PATTERN).count() == 0
    assert bpe.round_trip(empty, RANKS, public_tokenizers.PATTERN).count() == 0


def test_long_words(spark):
    """Words of one letter, of random letters and of other scripts, longer than a block, against the library."""
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(6)
    words = ["".join(rng.choice(letters) for _ in range(n)) for letters in ("a", "ab", "etaoinshr", "éßü", "中文字", "=") for n in (127, 128, 129, 300, 1500)]
    words += ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n)) for n in (257, 4000)]
    frame = spark.createDataFrame(list(enumerate(words)), "doc_id long, text string")
    for most in (1 << 20, 0):
        got = bpe.encoded(frame, RANKS, public_tokenizers.PATTERN, most).collect()
        assert {r["doc_id"]: r["ids"] for r in got} == {i: library.encode_ordinary(w) for i, w in enumerate(words)}


def test_language(spark, docs, empty):
    real = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = language.fitted(real)
    rows = language.predicted(real, model).join(real.select("doc_id", "lang"), "doc_id").where(language.held_out(F.col("doc_id")))
    found = [(r["lang"] == r["lang_pred"], r["rejected"], r["score"]) for r in rows.collect()]
    assert sum(ok for ok, _, _ in found) >= 0.97 * len(found)
    assert not any(out for _, out, _ in found) and all(0 <= s <= 1 for _, _, s in found)
    none = {r["doc_id"]: r for r in language.predicted(docs, model).collect()}
    for d in (0, 1, 2, 9):
        assert (none[d]["lang_pred"], none[d]["score"], none[d]["rejected"]) == ("und", 0.0, True)
    marks = ["the and", "\u0301\u0300", "12 \u0301", "of the", "\u0303", "é"]
    assert [n == "und" for n in model.predict(marks)[0]] == [False, True, True, False, True, False]
    for blank in ("\u0301", "", None):
        together = model.predict(["the and", blank, "of the", blank, blank])
        for i in (0, 2):
            alone = model.predict([["the and", 0, "of the"][i]])
            assert together[1][i] == alone[1][0] and together[2][i] == alone[2][0]
    foreign = spark.createDataFrame([(1, "Съешь же ещё этих мягких французских булок да выпей чаю", None, None, None)], SCHEMA)
    assert language.predicted(foreign, model).first()["rejected"]
    assert language.accepted(docs, model).columns == docs.columns
    blank = language.fitted(empty)
    assert {r["lang_pred"] for r in language.predicted(docs, blank).collect()} == {"und"}
    assert language.predicted(empty, model).count() == 0


def test_texts_are_scored_whole_and_one_by_one():
    model = language.train(["der die das und nicht", "the and of that with"] * 20, ["de", "en"] * 20)
    long = "the and of that with " * 60_000
    together, one = model.predict(["", "und die", long, "İx the"]), model.predict([long])
    assert together[0][2] == "en" and together[1][2] == pytest.approx(one[1][0])


def plain_segments(scores):
    """All maximal scoring segments by their definition: split at the best, longest first among equals."""
    best = None
    for i in range(len(scores)):
        for j in range(i + 1, len(scores) + 1):
            s = sum(scores[i:j])
            if s > 0 and (best is None or s > best[0] + 1e-9):
                best = (s, i, j)
    if best is None:
        return []
    s, i, j = best
    left, right = plain_segments(scores[:i]), plain_segments(scores[j:])
    return left + [(i, j, s)] + [(a + j, b + j, x) for a, b, x in right]


def test_segments_are_the_maximal_ones():
    rng = random.Random(5)
    for _ in range(300):
        scores = [rng.choice([-1.25, 2.0, 0.77, -3.1, 1.31]) + rng.random() / 100 for _ in range(rng.randint(0, 14))]
        own = [(i, s) for i, s in enumerate(scores)]
        got = toxicity.segments([i for i, _ in own], [s for _, s in own], 1.0)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in plain_segments(scores)]
    assert toxicity.segments([2, 4], [3.0, 2.0], 0.5) == [(2, 5, 4.5)]


def test_toxicity(spark, docs, empty):
    d = "/root/testdata/sf0.01"
    real, labels = (spark.read.parquet(f"{d}/{n}.parquet") for n in ("documents", "labels"))
    model = toxicity.fitted(real, labels)
    rows = toxicity.scored(real, model).join(labels, "doc_id").collect()
    right = [(r["score"] >= 0.5) == bool(r["toxic"]) for r in rows]
    assert sum(right) >= 0.93 * len(right)
    assert sum(r["score"] >= 0.5 for r in rows if not r["toxic"]) <= 2
    assert all(r["passages"] for r in rows if r["score"] >= 0.5)
    assert all(0 <= r["score"] <= 1 for r in toxicity.scored(docs, model).collect())
    assert toxicity.harmless(docs, model).columns == docs.columns
    assert toxicity.scored(empty, model).count() == 0
    assert toxicity.scored(docs, toxicity.fitted(docs, labels.limit(0))).count() == docs.count()


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(2)
    base_rows = [(i, rng.normal(size=8).tolist()) for i in range(400)]
    odd = [(1000, None), (1001, [0.0] * 8), (1002, [float("nan")] + [1.0] * 7), (None, [1.0] * 8), (1003, [None] + [1.0] * 7), (1004, [1.0, 2.0])]
    same = [(2000 + i, base_rows[0][1]) for i in range(40)]
    rows = base_rows + odd + same + base_rows[:2]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("shard", F.lit("x"))
    index = neighbours.build(frame, 5, shard=100)
    got = neighbours.search(index, frame.where("vec_id % 50 = 0"), 5).collect()
    full = {i: np.array(v) for i, v in base_rows + same}
    hits = total = 0
    for q in [i for i in full if i % 50 == 0]:
        cos = lambda v: float(v @ full[q] / np.sqrt(v @ v) / np.sqrt(full[q] @ full[q]))  # noqa: B023, E731
        want = sorted(((-round(cos(v), 9), i) for i, v in full.items() if i != q))[:5]
        found = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5]
        assert all(abs(s - cos(full[i])) < 1e-12 for _, i, s in found)
        hits += len({i for _, i, _ in found} & {i for _, i in want})
        total += 5
    assert hits >= 0.95 * total
    assert neighbours.search(neighbours.build(frame.limit(0)), frame, 5).count() == 0


def test_neighbours_recall(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = neighbours.search(neighbours.build(vectors), vectors.where("vec_id % 50 = 0"), 5).collect()
    rows = vectors.collect()
    ids, v = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], np.float64)
    v /= np.sqrt((v**2).sum(axis=1))[:, None]
    found = {}
    for r in got:
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for i in np.flatnonzero(ids % 50 == 0):
        s = v @ v[i]
        s[i] = -2
        hits += len(found[ids[i]] & set(ids[np.argsort(-s)[:5]].tolist()))
    assert hits >= 0.95 * 5 * len(found)


def test_chat(spark):
    rows = [(1, i, r, t) for i, (r, t) in enumerate([("system", "be <b>\\l"), ("user", "a " * 300), ("assistant", "</turn>\n<turn x>"), ("assistant", None), (None, "x\\b"), ("us>er\n", "y " * 700), ("assistant", "z " * 100)])]
    rows += [(1, 6, "assistant", "z " * 100), (None, 0, "user", "n"), (2, None, "assistant", ""), (2, 0, "user", "u")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("stretch", F.lit("x"))
    made = chat.windows(frame)
    got = {r["conv_id"]: r for r in chat.read_back(made).collect()}
    for c in (1, 2, None):
        order = sorted(((t is not None, t or 0, r or "", x or "") for k, t, r, x in rows if k == c))
        text = "".join(f"{r}\n{x}\n" for _, _, r, x in order)
        loss = "".join(x for _, _, r, x in order if r == "assistant")
        assert got[c]["turns_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    for r in made.where("conv_id = 1").collect():
        assert r["text"].startswith("<turn system>\n") and r["text"].count("</turn>\n") == len(r["turns"])
        assert sum(t["is_loss"] for t in r["turns"]) <= sum(t["is_new"] for t in r["turns"])
    assert chat.windows(frame.limit(0)).count() == 0


def test_licenses(spark, docs, empty):
    model = licenses.fitted(docs)
    rows = [(1, "text\nReleased under the MIT License.\nmore"), (2, "Licensed under CC BY-NC 4.0."), (3, PROSE), (4, None), (5, "the license of the dog is under the tree"),
            (6, "This work is licensed under the GNU General Public License, version 3."), (7, "Licensed under the Apache License, Version 2.0.")]
    found = {r["doc_id"]: r["licenses"] for r in licenses.found(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert found == {1: ["MIT"], 2: ["CC-BY-NC"], 3: [], 4: [], 5: [], 6: ["GPL"], 7: ["Apache-2.0"]}
    assert licenses.found(empty, model).count() == 0


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_sql(spark, name):
    from tools.check_oracle import rows_of

    db = duckdb.connect()
    for t in ("documents", "conversations"):
        db.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    df = Q.QUERIES[name](spark, SF_DIR)
    cursor = db.execute(Q.ORACLE[name])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of([c[0] for c in cursor.description], cursor.fetchall())

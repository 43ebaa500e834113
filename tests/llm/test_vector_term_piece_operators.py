"""Centroid clustering, source divergence, SentencePiece encoding: edge cases, SQL and brute force."""

import hashlib
import random
import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from compare import connect, differences, spark_rows, sql_rows  # noqa: E402

from tradewind.llm import centroids, divergence, pieces, queries  # noqa: E402

SF = "/root/testdata/sf0.01"
VECTORS = "vec_id long, embedding array<double>, cluster string, label int"
DOCS = "doc_id long, text string, lang string, source string, term string, count int"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    got = spark_rows(queries.QUERIES[name](spark, SF))
    assert differences(got, sql_rows(connect(SF), queries.ORACLE_SQL[name])) is None


# centroids


def nearest_brute(vectors, points):
    found = []
    for v in vectors.tolist():
        best = min((sum((a - b) ** 2 for a, b in zip(v, p)), c) for c, p in enumerate(points.tolist()))
        found.append((best[1], best[0]))
    return found


@pytest.mark.parametrize("count, width, spread", [(1, 3, 5), (2, 1, 2), (7, 2, 2), (40, 3, 4), (200, 8, 30), (16, 64, 1 << 26)])
def test_tree_finds_the_nearest_point_and_the_smallest_of_ties(count, width, spread):
    rng = np.random.default_rng(count)
    points = rng.integers(-spread, spread + 1, (count, width))
    vectors = np.concatenate([rng.integers(-spread, spread + 1, (300, width)), points])
    number, distance = centroids.VantagePointTree(points).nearest(vectors)
    assert list(zip(number.tolist(), distance.tolist())) == nearest_brute(vectors, points)


def test_tree_prunes(monkeypatch):
    rng = np.random.default_rng(5)
    points = rng.integers(0, 1 << 20, (512, 2))
    tree, seen = centroids.VantagePointTree(points), []
    real = centroids.squared
    monkeypatch.setattr(centroids, "squared", lambda x, y: seen.append(len(x)) or real(x, y))
    tree.nearest(rng.integers(0, 1 << 20, (400, 2)))
    assert sum(seen) < 400 * 512 / 4


def clustered_brute(rows, count, rounds, dimensions, scale):
    kept = [(i, [int(np.floor(scale * x)) for x in v]) for i, v in rows
            if v is not None and len(v) == dimensions and all(x is not None and np.isfinite(x) for x in v)]
    start = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:count]
    points = [v for _, v in start]
    for _ in range(rounds):
        members = defaultdict(list)
        for (_, v), (c, _) in zip(kept, nearest_brute(np.array([v for _, v in kept]), np.array(points))):
            members[c].append(v)
        points = [[sum(x) // len(members[c]) for x in zip(*members[c])] if c in members else p for c, p in enumerate(points)]
    found = nearest_brute(np.array([v for _, v in kept]), np.array(points))
    return sorted(((i, c, d) for (i, _), (c, d) in zip(kept, found)), key=repr), points


def test_clustering_like_brute_force_with_odd_rows(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([-1.5, -0.26, 0.0, 0.1, 0.5, 2.0]) for _ in range(4)]) for i in range(60)]
    rows += [(3, rows[3][1]), (3, rows[3][1]), (100, rows[4][1]), (None, [0.1, 0.1, 0.1, 0.1]), (None, None)]
    rows += [(200, None), (201, []), (202, [1.0] * 3), (203, [1.0] * 5), (204, [1.0, None, 1.0, 1.0])]
    rows += [(205, [1.0, float("nan"), 1.0, 1.0]), (206, [float("inf"), 0.0, 0.0, 0.0]), (207, [-float("inf")] * 4)]
    given_rows = spark.createDataFrame([(i, v, "clash", 1) for i, v in rows], VECTORS).repartition(5)
    for count, rounds in ((5, 3), (1, 1), (100, 2)):
        found = centroids.clustered(given_rows, count, rounds, 4)
        got = sorted(map(tuple, found.assignments.collect()), key=repr)
        expected, points = clustered_brute(rows, count, rounds, 4, 64)
        assert got == expected and found.centroids == points
        assert {r.cluster: r.cluster_inertia for r in centroids.inertia(found).collect()} == {
            c: sum(d for _, x, d in expected if x == c) for c in {x for _, x, _ in expected}
        }


def test_clustering_of_nothing_and_of_too_much(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert centroids.clustered(empty).assignments.count() == 0
    assert centroids.clustered(spark.createDataFrame([(None, [1.0] * 64, "", 1)], VECTORS)).centroids == []
    huge = spark.createDataFrame([(1, [1e300] * 64, "", 1)], VECTORS)
    with pytest.raises(Exception, match="a component is beyond"):
        centroids.clustered(huge)


# divergence


@pytest.mark.parametrize("count", [0, 1, 2, 3, 50, 5000])
def test_shard_is_a_minimal_perfect_hash(count):
    keys = [f"en\xff{i}".encode("latin-1") for i in range(count)]
    shard = divergence.build_shard(keys)
    hashes = np.array([divergence.key_hash(k) for k in keys], dtype=np.uint64)
    assert sorted(shard.slots(hashes, keys).tolist()) == list(range(count)) and len(shard) == count
    others = [b"fr\xff" + k for k in keys] + [b"nothing"]
    hashes = np.array([divergence.key_hash(k) for k in others], dtype=np.uint64)
    assert set(shard.slots(hashes, others).tolist()) <= {-1}


def test_keys_of_one_hash_have_slots_of_their_own(monkeypatch):
    monkeypatch.setattr(divergence, "key_hash", lambda key: len(key))
    keys = [b"a", b"b", b"cc", b"dd", b"eee"]
    shard = divergence.build_shard(keys)
    hashes = np.array([len(k) for k in keys], dtype=np.uint64)
    assert sorted(shard.slots(hashes, keys).tolist()) == list(range(5))
    assert divergence.Shard.slots(shard, hashes[:1], [b"z"]).tolist() == [-1]


def test_key_hash_is_that_of_the_engine(spark):
    for text in ("", "a", "é" * 40):
        got = spark.createDataFrame([(text.encode(),)], "k binary").selectExpr("xxhash64(k) AS h").collect()[0].h
        assert got % (1 << 64) == divergence.key_hash(text.encode())


def audit_brute(rows, least, top):
    import re

    words = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [(lang or "", source or "", words.findall((text or "").translate(lower))) for text, lang, source in rows]
    held = Counter((lang, t) for lang, _, found in docs for t in set(found))
    kept = defaultdict(list)
    for (lang, term), n in held.items():
        if n >= least:
            kept[lang].append(term)
    counts = Counter((lang, source, t) for lang, source, found in docs for t in found if held[lang, t] >= least)
    of_lang = Counter()
    for (lang, _, t), n in counts.items():
        of_lang[lang, t] += n
    groups = sorted({(lang, source) for lang, source, _ in docs})
    out = []
    for lang, source in groups:
        v = len(kept[lang])

        def share(source, term):
            total = sum(counts[lang, source, t] for t in kept[lang])
            return 1 + 10**9 * (counts[lang, source, term] + 5) // (total + 5 * v)

        pairs = [(-sum(abs(share(source, t) - share(o, t)) for t in kept[lang]), o.encode(), o) for x, o in groups if x == lang and o != source]
        out += [(lang, source, "pair", o, -value, i) for i, (value, _, o) in enumerate(sorted(pairs), 1)]
        total = sum(of_lang[lang, t] for t in kept[lang])
        more = []
        for t in kept[lang]:
            apart = share(source, t) - (1 + 10**9 * (of_lang[lang, t] + 5) // (total + 5 * v))
            if counts[lang, source, t] and apart > 0:
                more.append((-apart, t.encode(), t))
        out += [(lang, source, "term", t, -value, i) for i, (value, _, t) in enumerate(sorted(more)[:top], 1)]
    return sorted(out)


def counted(recounted):
    """Counts by group and term, which don't depend on slots."""
    counts, keys = recounted
    return sorted(map(tuple, counts.join(keys, ["slot", "lang"]).select("lang", "source", "term", "count").collect()))


def test_audit_like_brute_force_with_odd_rows(spark, monkeypatch):
    rng = random.Random(8)
    vocabulary = ["Term", "TERM2x", "été", "Été", "über", "漢字", "a", "İ", "b-c", "x9y", "z" * 300, "q", "r", "s"]
    rows = []
    for _ in range(160):
        text = " ".join(rng.choice(vocabulary[: rng.randint(3, 14)]) for _ in range(rng.randint(0, 9)))
        rows.append((text, rng.choice(["en", "en", "fr", "", None]), rng.choice(["hot", "hot", "hot", "b", "é", None, ""])))
    rows += [(None, "en", "b"), ("", "xx", "only"), (None, "xx", None), ("...!", "yy", "a"), ("word " * 30000, "en", "long"), rows[0], rows[0]]
    docs = spark.createDataFrame([(i, *r, "clash", 1) for i, r in enumerate(rows)], DOCS).repartition(4)
    expected = audit_brute(rows, 4, 3)
    assert sorted(map(tuple, divergence.audit(docs, 4, 3).collect())) == expected
    # Many shards, several passes, folds in the middle of a task and small blocks give the same.
    for name, value in (("SHARD_KEYS", 2), ("CELLS", 8)):
        monkeypatch.setattr(divergence, name, value)
    kept = divergence.kept_terms(docs, 4)
    few = counted(divergence.recount(docs, kept, shard_keys=2, pass_bytes=100))
    monkeypatch.setattr(divergence, "MERGED", 2)
    assert few == counted(divergence.recount(docs, kept))
    assert sorted(map(tuple, divergence.audit(docs, 4, 3).collect())) == expected


def test_tallies_that_are_handed_on_early_count_the_same(spark, tmp_path):
    import json
    import subprocess

    # The bounds are read in tasks, so a session of its own ships code with small ones.
    code = """
import json, sys
sys.path[:0] = [sys.argv[1], sys.argv[1] + "/tests"]
from tradewind.llm import divergence
from tradewind.session import build_session
spark = build_session("t", "local[2]", 2, **{"spark.ui.enabled": "false", "spark.checkpoint.dir": sys.argv[2]})
spark.sparkContext.setLogLevel("OFF")
docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
kept = divergence.kept_terms(docs, 5)
counts, keys = divergence.recount(docs, kept)
rows = counts.join(keys, ["slot", "lang"]).select("lang", "source", "term", "count").collect()
print(json.dumps(sorted(map(list, rows))))
"""
    root = Path(__file__).resolve().parents[2]
    small = tmp_path / "small"
    (small / "tradewind").mkdir(parents=True)
    import shutil

    shutil.copytree(root / "tradewind", small / "tradewind", dirs_exist_ok=True)
    source = small / "tradewind/llm/divergence.py"
    source.write_text(source.read_text().replace("TALLY = 200_000", "TALLY = 50").replace("SLOT_BYTES = 48_000_000", "SLOT_BYTES = 2_000").replace("TOGETHER = 300_000", "TOGETHER = 100"))
    run = subprocess.run([sys.executable, "-c", code, str(small), str(tmp_path / "shared")], capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    expected = counted(divergence.recount(docs, divergence.kept_terms(docs, 5)))
    assert json.loads(run.stdout.strip().splitlines()[-1]) == list(map(list, expected))


def test_audit_of_nothing(spark):
    assert divergence.audit(spark.createDataFrame([], DOCS)).count() == 0


# pieces


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=queries.piece_model_path())


@pytest.fixture(scope="module")
def coder():
    return pieces.Coder(pieces.read_model(queries.piece_model_path()))


def same(coder, library, text):
    ids = np.frombuffer(coder.encode(text), "<u4")
    assert ids.tolist() == library.encode(text, add_bos=True, add_eos=True)
    assert coder.decode(ids) == library.decode(ids.tolist())


ODD = st.sampled_from([" ", "  ", "▁", "\n", "\r\n", "\t", "\x00", "é", "́", "漢", "😀", "ﬁ", "<s>", "</s>", "<0x41>", "the", " the", "ing", "�", " "])


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), st.lists(ODD, max_size=25).map("".join), st.text(alphabet="aeinrst ", max_size=80)))
def test_encoding_is_the_librarys(coder, library, text):
    same(coder, library, text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 31999) | st.integers(0, 262), max_size=12))
def test_decoding_is_the_librarys(coder, library, ids):
    assert coder.decode(np.array(ids, dtype=np.uint32)) == library.decode(ids)


def test_runs_of_blanks_and_long_texts(coder, library):
    for n in (1, 2, 15, 16, 17, 31, 32, 33, 100):
        same(coder, library, " " * n)
        same(coder, library, " " * n + "the" + " " * n)
    rng = random.Random(2)
    same(coder, library, "".join(rng.choice("abcdefgh漢字ing") for _ in range(200_000)))
    same(coder, library, "ab cd\n" * 50_000)


def test_backtracking_is_needed_and_linear(coder, library):
    """Greedy longest pieces alone would be wrong somewhere, and a place is tried once."""
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(12)) for _ in range(300)]
    greedy = [[coder.pieces[p] for _, p in coder.automaton.iter_long("▁" + w)] for w in words]
    found = [list(map(coder._text, coder.backtracked("▁" + w))) for w in words]
    assert greedy != found
    assert found == [library.encode(w, out_type=str) for w in words]


def test_cuts_taken_together_equal_those_taken_alone(coder, library, monkeypatch):
    rng = random.Random(6)
    parts = [*coder.pieces[::7], " ", "  ", "\n", "▁", "漢", "😀", "é", "\x00", "\t"]
    texts = ["".join(rng.choice(parts).replace("▁", " ") for _ in range(rng.randint(0, 30))) for _ in range(3000)] + [None, "", "\n", " "]
    for pairs in (100_000, 40):
        monkeypatch.setattr(pieces, "KEPT_PAIRS", pairs)
        fresh = pieces.Coder(coder.model)
        found = fresh.encode_all(texts)
        assert [np.frombuffer(f, "<u4").tolist() for f in found] == [library.encode(t or "", add_bos=True, add_eos=True) for t in texts]


def test_kept_ids_stay_bounded(monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_BYTES", 20_000)
    monkeypatch.setattr(pieces, "KEPT_PAIRS", 50)
    monkeypatch.setattr(pieces, "KEPT_EDGES", 20)
    coder = pieces.Coder(pieces.read_model(queries.piece_model_path()))
    rng = random.Random(9)
    for _ in range(60):
        coder.encode(" ".join(f"w{rng.randrange(100000)}" for _ in range(40)))
    assert len(coder.kept) + len(coder.older) < 400 and len(coder.pairs) <= 50 and len(coder.edges) <= 20


def test_models_that_alter_texts_are_refused(monkeypatch):
    monkeypatch.setattr(pieces, "_PROBE", "▁")
    monkeypatch.setattr(sentencepiece.SentencePieceProcessor, "normalize", lambda self, text: text.lower())
    with pytest.raises(ValueError, match="alters texts"):
        pieces.read_model(public_tokenizers.path(pieces.VOCABULARY))


def test_coding_of_tables(spark, library):
    texts = [None, "", "a b", "a b", " lead", "tail ", "x\n\ny", "long " * 60_000, "😀"]
    rows = [(i, t, None, "s", "clash", 1) for i, t in enumerate(texts)] + [(None, "no id", None, None, None, None), (1, "again", "", "", "", 2)]
    docs = spark.createDataFrame(rows, DOCS)
    path = queries.piece_model_path()
    got = pieces.round_trip(docs, path).collect()
    expected = sorted(((r[0], tuple(library.encode(r[1] or "", add_bos=True, add_eos=True)), r[1] or "") for r in rows), key=repr)
    assert sorted(((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist()), r.decoded) for r in got), key=repr) == expected
    assert all(r.n_tokens == len(r.ids) // 4 for r in got)
    bare = pieces.encoded(docs, path, begin=False, end=False)
    assert {bytes(r.ids) for r in bare.where("doc_id = 2").collect()} == {np.array(library.encode("a b"), "<u4").tobytes()}
    back = pieces.decoded(bare, path)
    assert sorted(r.text for r in back.collect()) == sorted(r[1] or "" for r in rows)
    assert pieces.round_trip(docs.where("false"), path).count() == 0


def test_query_over_all_documents_is_the_librarys(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in queries.op13_sentencepiece(spark, SF).collect()}
    assert len(got) == len(docs)
    for doc_id, text in docs:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        row = got[doc_id]
        assert (row.n_tokens, row.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()

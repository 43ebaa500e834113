"""URL filters, decontamination, substring and near dedup, the pipeline: edge cases and brute force."""

import random
import re

import duckdb
import numpy as np
import pytest
import corpus_pipeline
from pyspark.sql import functions as F
from tradewind.llm import decontamination, near, passages, queries, urls
from tradewind.llm.components import components
from tradewind.llm.words import hashed_words

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, identity double, _doc string, label int"


def prose(seed, n):
    rng = random.Random(seed)
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def frame(spark, texts):
    rows = [(i, t, None, None, None if t is None else len(t), None, "x", 1) for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


# urls


def url_brute(url):
    after = re.search(r"://(.*)", url or "", re.S)
    if not after:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", after[1], re.S).groups()
    return "".join(c.lower() if c.isascii() else c for c in host), path


def test_urls_rules_like_brute_force(spark):
    odd = [None, "", "no scheme", "http://", "HTTP://A.Example.ORG/es/x?q#f", "x://org", "x://org/", "x://notorg/", "a://b.example.org/en/12",
           "a://example.com/de/1", "a://example.com?/fr/", "a://É.org/ü#", "a://b://c.org/"]
    given = duckdb.sql(f"select page_id, url from '{SF}/pages.parquet'").fetchall()
    rows = given + [(-i, u) for i, u in enumerate(odd, 1)] + [(None, "q://org/z"), (-5, odd[4])]
    pages = spark.createDataFrame([(i, u, None, "clash") for i, u in rows], "page_id long, url string, html string, verdict string")
    got = urls.judged_pages(pages, queries.URL_RULES).collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: r for r in got}
    for page_id, url in rows:
        host, path = url_brute(url)
        fits = [r for r in queries.URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.text), default=None)
        row = by_id[page_id]
        assert (row.host, row.path, row.rule) == (host, path, best and best.text)
        if best:
            assert row.verdict == best.verdict
    assert by_id[-1].verdict == "allow"
    assert urls.judged_pages(pages.where("false"), queries.URL_RULES).count() == 0


def test_trust_and_distrust_flow_over_links(spark):
    link = lambda *hosts: "".join(f'<a href="https://{h}/p">x</a>' for h in hosts)
    pages = [
        (1, "http://bad.com/de/1", ""), (2, "http://spam.net/1", link("bad.com", "bad.com", "spam.net")),
        (3, "http://good.com/fr/1", link("fine.net")), (4, "http://fine.net/1", link("BAD.com")), (5, "http://lone.net/1", None),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in urls.judged_pages(df, queries.URL_RULES).collect()}
    assert {i: got[i] for i in (1, 2, 3, 5)} == {1: "block", 2: "block", 3: "allow", 5: "allow"}
    edges = {(r.source, r.target): r.pages for r in urls.host_edges(df).collect()}
    assert edges == {("spam.net", "bad.com"): 1, ("good.com", "fine.net"): 1, ("fine.net", "bad.com"): 1}
    scores = {(r.kind, r.host): r.score for r in urls.propagated(
        spark.createDataFrame([("allow", "good.com", 1.0), ("block", "bad.com", 1.0)], "kind string, host string, weight double"),
        spark.createDataFrame([(a, b, n) for (a, b), n in edges.items()], "source string, target string, pages long")).collect()}
    base, d = 1 - urls.DAMPING, urls.DAMPING
    want = {("allow", "good.com"): base, ("allow", "fine.net"): base * d, ("allow", "bad.com"): base * d * d, ("block", "bad.com"): base,
            ("block", "spam.net"): base * d / 2, ("block", "fine.net"): base * d / 2, ("block", "good.com"): base * d * d / 2}
    assert scores == pytest.approx(want)


# components


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 3), (5, 4), (4, 5), *[(i, i + 1) for i in range(10, 40)], (None, 1), (7, None)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, **{i: 10 for i in range(10, 41)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# near duplicates


def changed(words, at):
    return [f"z{i}" if i in at else w for i, w in enumerate(words)]


def test_near_classes_of_planted_copies(spark):
    base = prose(1, 400)
    texts = [(10, " ".join(base)), (3, " ".join(changed(base, {50, 300}))), (11, " ".join(base)), (12, " ".join(changed(base, set(range(0, 400, 15)))))]
    texts += [(20 + i, " ".join(prose(100 + i, 200))) for i in range(40)]
    texts += [(1, None), (2, None), (4, ""), (5, ""), (6, "one two"), (7, "one two"), (8, "one three"), (10, " ".join(base)), (None, " ".join(base)), (None, None)]
    docs = frame(spark, texts)
    rows = near.classes(docs).collect()
    assert len(rows) == len(texts)
    got = {r.doc_id: r.class_id for r in rows if r.doc_id is not None}
    want = {i: i for i, _ in texts if i is not None} | {10: 3, 11: 3, 5: 4, 7: 6}
    assert got == want
    stay = near.without_copies(docs)
    assert stay.columns == docs.columns
    assert sorted(r.doc_id for r in stay.collect() if r.doc_id is not None) == sorted(i for i, c in want.items() if i == c)
    assert near.classes(docs.where("false")).count() == 0 == near.without_copies(docs.where("false")).count()


def test_near_classes_like_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: near.labelled_shingles(r.text.encode()) for r in docs.select("doc_id", "text").collect()}
    ids, parent = sorted(texts), {i: i for i in texts}
    owners = {}
    for i in ids:
        for s in texts[i].tolist():
            owners.setdefault(s, []).append(i)

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    pairs = {(a, b) for group in owners.values() if len(group) < 60 for k, a in enumerate(group) for b in group[k + 1 :]}
    for a, b in pairs:
        if near.similarity(texts[a], texts[b]) >= near.SIMILARITY:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    assert {r.doc_id: r.class_id for r in near.classes(docs).collect()} == {i: find(i) for i in ids}


def test_near_classes_of_large_buckets(spark):
    """Pairs that are alike while others of their buckets aren't: each of 24 words has two forms, and five differences
    are too many. No form belongs to few texts, so nearly all buckets are of more than SMALL texts."""
    base, places, rng = prose(2, 200), range(4, 196, 8), random.Random(3)
    forms = []
    for _ in range(300):
        form = rng.getrandbits(24)
        forms += [form, form ^ sum(1 << p for p in rng.sample(range(24), 3))]
    parent = list(range(len(forms)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for b in range(len(forms)):
        for a in range(b):
            if (forms[a] ^ forms[b]).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    texts = [" ".join(changed(base, {p for k, p in enumerate(places) if form >> k & 1})) for form in forms]
    got = {r.doc_id: r.class_id for r in near.classes(frame(spark, list(enumerate(texts)))).collect()}
    assert got == {i: find(i) for i in range(len(forms))}


def test_near_classes_of_few_texts_of_a_large_bucket(spark):
    """A text and 20 copies of it with eight changes each, among 700 with ten changes that are like no other: all share
    large buckets, whose other texts are no way from a copy to its text."""
    base, rng = prose(7, 404), random.Random(8)
    rows = []
    for i, n in enumerate([0] + [8] * 20 + [10] * 700):
        at = set(rng.sample(range(4, 400, 8), n))
        rows.append((900 - i, " ".join(f"own{i}" if place in at else w for place, w in enumerate(base))))
    got = {r.doc_id: r.class_id for r in near.classes(frame(spark, rows)).collect()}
    shingles = {i: near.labelled_shingles(t.encode()) for i, t in rows}
    alike = [i for i in got if near.similarity(shingles[900], shingles[i]) >= near.SIMILARITY]
    assert len(alike) == 21 and got == {i: min(alike) if i in alike else i for i in got}


def test_leaders_of_large_buckets_merge_copies_of_one_text(spark):
    """150 copies of a text with eight changes each, which are like the text but not like each other: once each is
    compared with its leaders, no pairs of them are left."""
    base, rng = prose(9, 404), random.Random(9)
    texts = [" ".join(base)]
    for i in range(150):
        at = set(rng.sample(range(4, 400, 8), 8))
        texts.append(" ".join(f"own{i}" if place in at else w for place, w in enumerate(base)))
    docs = frame(spark, list(enumerate(texts)))
    named = F.col("doc_id").alias("first"), near._text_key(F.col("text")).alias("key"), near._signatures(F.col("text")).alias("signatures")
    near.ship_package(spark)
    nodes = near.written(docs.select(*named), "nodes")
    members = near.buckets(nodes)
    pairs = near.candidates(members)
    assert pairs.where("a >= b").isEmpty()
    found = components(near.links(docs, nodes, pairs))
    assert near.further_candidates(docs, nodes, members, found).count() <= 5
    assert {r.class_id for r in near.classes(docs).collect()} == {0}


def test_outlines_rule_out_no_similar_pair():
    rng = np.random.default_rng(5)
    for n in (1, 9, 40, 300, 6000):
        for share in (0.05, 0.1, 0.11, 0.2):
            a = rng.permutation(1 << 20)[:n].astype("<u4")
            b = np.where(rng.random(n) < share, rng.integers(1 << 20, 1 << 21, n), a).astype("<u4")[: n - int(n * share / 9)]
            x, y = near.outline(a), near.outline(b)
            assert x.tolist() == near.outline(a[::-1]).tolist() and (x[0], len(x)) == (n, 1 + near.OUTLINE // 64)
            odd = int(np.bitwise_count((x[1:] ^ y[1:]).view(np.uint64)).sum())
            both = len(np.intersect1d(a, b))
            assert odd <= len(a) + len(b) - 2 * both
            if near.similarity(a, b) >= near.SIMILARITY:
                assert 9 * odd <= len(a) + len(b)
    assert near.outline(np.zeros(0, "<u4")).tolist() == [0] * (1 + near.OUTLINE // 64)


def test_banded_alignment_is_the_longest_common_subsequence():
    rng = np.random.default_rng(2)
    for _ in range(50):
        a = rng.permutation(40)[:30].astype(np.uint64)
        b = np.concatenate([a[:10], rng.permutation(np.arange(100, 106)).astype(np.uint64), a[12:]])
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
        assert near.aligned(a, b, 70) == table[-1, -1]
    assert near.similarity(a[:0], b) == 0.0 and near.similarity(a, a) == 1.0


# substring dedup


def test_passages_of_planted_repeats(spark):
    shared, fuzzy = prose(5, 60), prose(6, 80)
    edited = fuzzy[:30] + ["zz"] + fuzzy[31:50] + fuzzy[52:]
    texts = [
        (1, prose(11, 100) + shared + prose(12, 100)), (2, prose(13, 30) + shared + prose(14, 90)), (3, shared),
        (4, prose(15, 50) + fuzzy), (5, edited + prose(16, 50)), (6, prose(17, 300)), (7, shared[:30] + prose(18, 100)),
    ]
    texts = [(i, " ".join(w)) for i, w in texts] + [(8, None), (9, ""), (None, " ".join(shared)), (6, " ".join(prose(17, 300)))]
    docs = frame(spark, texts)
    got = {r.doc_id: (r.start_word, r.end_word, r.source_doc_id, r.source_start_word) for r in passages.passages(docs).collect()}
    assert got[5][0] == 0 and 75 <= got[5][1] <= 82 and got[5][2:] == (4, 50)
    assert got.keys() == {2, 3, 5} and got[2] == (30, 90, 1, 100) and got[3] == (0, 60, 1, 100)
    cut = passages.without_repeats(docs)
    assert cut.columns == docs.columns
    left = {r.doc_id: r for r in cut.collect() if r.doc_id is not None}
    assert left[2].text == " ".join(prose(13, 30) + prose(14, 90)) and left[2].n_chars == len(left[2].text)
    assert 3 not in left and left[8].text is None and left[9].text == "" and left[1].text == texts[0][1]
    assert passages.passages(docs.where("false")).count() == 0 == passages.without_repeats(docs.where("false")).count()


def test_passages_cover_exact_repeats_of_the_corpus(spark):
    """Words in windows of 50 that an earlier document has, by brute force, are covered; clean documents aren't hit."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: hashed_words(r.text.encode()).tolist() for r in docs.select("doc_id", "text").collect()}
    first, repeated = {}, {}
    for i in sorted(texts):
        words = texts[i]
        own = {tuple(words[k : k + 50]) for k in range(len(words) - 49)}
        marks = {k + j for k in range(len(words) - 49) if tuple(words[k : k + 50]) in first for j in range(50)}
        if marks:
            repeated[i] = marks
        for w in own:
            first.setdefault(w, i)
    covered = {}
    for r in passages.passages(docs).collect():
        covered.setdefault(r.doc_id, set()).update(range(r.start_word, r.end_word))
    hit = sum(len(marks & covered.get(i, set())) for i, marks in repeated.items())
    # Where edited copies own the seeds of one passage by turns, gaps of a few words stay between the spans.
    assert hit >= 0.9 * sum(map(len, repeated.values()))
    assert len(covered.keys() & repeated.keys()) >= 0.98 * len(repeated)
    # What is found beyond exact windows is fuzzy: half of its five-word runs stand in other documents.
    runs = {}
    for i, words in texts.items():
        for k in range(len(words) - 4):
            runs.setdefault(tuple(words[k : k + 5]), set()).add(i)
    for i, places in covered.items():
        alike = [len(runs[tuple(texts[i][k : k + 5])]) > 1 for k in places if k < len(texts[i]) - 4]
        assert np.mean(alike) > 0.3


def test_chaining_beats_no_other_choice():
    """Against every chain of up to ten matches, close together and far beyond reach of each other."""
    rng = random.Random(4)
    for round_ in range(60):
        span = (40, 120, 400)[round_ % 3]
        points = sorted({(rng.randrange(span), rng.randrange(span)) for _ in range(10)})
        ours, theirs = [p[0] for p in points], [p[1] for p in points]

        def score(chain):
            return sum(
                passages.SEED - (passages.GAP_COST * (ours[b] - ours[a] + theirs[b] - theirs[a]) if a is not None else 0)
                for a, b in zip([None, *chain], chain)
            )

        best = 0.0
        for mask in range(1, 1 << len(points)):
            chain = [k for k in range(len(points)) if mask >> k & 1]
            if all(passages.follows(points[a], points[b]) for a, b in zip(chain, chain[1:])):
                best = max(best, score(chain))
        found = passages.chained(ours, theirs)
        assert score(found[0]) == pytest.approx(best) and sorted(k for c in found for k in c) == list(range(len(points)))
        assert all(passages.follows(points[a], points[b]) for c in found for a, b in zip(c, c[1:]))


def test_chains_of_many_matches_score_as_by_trying_all():
    rng = random.Random(9)
    for _ in range(20):
        points = sorted({(rng.randrange(600), rng.randrange(600)) for _ in range(150)} | {(i * 9, i * 9 + 5) for i in range(60)})
        scores = []
        for k, (x, y) in enumerate(points):
            behind = [scores[j] - passages.GAP_COST * (x - u + y - v) for j, (u, v) in enumerate(points[:k]) if passages.follows((u, v), (x, y))]
            scores.append(passages.SEED + max([0.0, *behind]))
        (first, *_) = passages.chained([p[0] for p in points], [p[1] for p in points])
        assert scores[first[-1]] == pytest.approx(max(scores))


def covered_words(docs):
    covered = {}
    for r in passages.passages(docs).collect():
        covered.setdefault(r.doc_id, set()).update(range(r.start_word, r.end_word))
    return covered


def test_passages_apart_and_around_an_insertion(spark):
    """Two passages of one owner with 30, 60 and 500 other words between, and a copy with 60 words put in."""
    one, two, copied = prose(70, 300), prose(71, 80), prose(72, 400)
    texts = [(1, one + prose(73, 90) + two), (5, copied)]
    between = {2: 30, 3: 60, 4: 500}
    texts += [(i, one + prose(80 + i, n) + two) for i, n in between.items()]
    texts += [(6, copied[:200] + prose(74, 60) + copied[200:])]
    covered = covered_words(frame(spark, [(i, " ".join(w)) for i, w in texts]))
    for i, n in between.items():
        wanted = {*range(300), *range(300 + n, 380 + n)}
        assert wanted <= covered[i] and len(covered[i]) < 385 + (n if n < 40 else 0)
    assert {*range(200), *range(260, 460)} <= covered[6] and len(covered[6]) <= 402
    short = covered_words(frame(spark, [(1, " ".join(one[:60] + prose(75, 40) + two)), (2, " ".join(one[:60] + prose(76, 40) + two))]))
    assert {*range(60), *range(100, 180)} <= short[2]


def test_passages_in_pieces_and_of_many_owners(spark):
    """A passage in pieces with two other words between, and one whose seeds earlier excerpts own one by one."""
    pieces, whole = prose(90, 55), prose(91, 120)
    texts = [(200, prose(92, 30) + whole + prose(93, 30)), (201, prose(94, 60) + whole), (1, pieces), (2, pieces[:30] + ["x1", "x2"] + pieces[30:])]
    at = passages.seeds(hashed_words(" ".join(whole).encode()))[1].tolist()
    texts += [(100 + k, prose(300 + k, 40) + whole[p : p + passages.SEED] + prose(400 + k, 40)) for k, p in enumerate(at)]
    covered = covered_words(frame(spark, [(i, " ".join(w)) for i, w in texts]))
    assert covered[2] == set(range(57))
    assert covered[201] == set(range(60, 180)) and not covered.keys() & set(range(100, 200))


def test_passages_that_a_document_has_again(spark):
    """A passage twice in a document, whole after a quoted part, and a run of one word alone."""
    whole, same = prose(95, 100), ["same"] * 300
    texts = [(1, prose(96, 50) + whole), (2, whole + prose(97, 80) + whole), (3, whole[30:60] + prose(98, 80) + whole), (4, same), (5, same)]
    covered = covered_words(frame(spark, [(i, " ".join(w)) for i, w in texts]))
    assert covered[2] == {*range(100), *range(180, 280)} and covered[3] == set(range(110, 210)) and covered[5] == set(range(300))
    assert covered.keys() == {2, 3, 5}


# decontamination


def test_leaks_of_planted_items(spark):
    items = [(1, " ".join(prose(50, 40)) + ". Answer is w1 w2"), (2, " ".join(prose(51, 120))), (3, None), (4, ""), (5, " ".join(prose(52, 15))), (None, " ".join(prose(53, 30)))]
    one = items[0][1].split()
    paraphrase = [w if k % 7 else f"q{k}" for k, w in enumerate(one)]
    texts = [(i, " ".join(prose(200 + i, 300))) for i in range(30)]
    texts += [(100, " ".join(prose(60, 77) + one + prose(61, 200)).upper()), (101, " ".join(prose(62, 40) + paraphrase + prose(63, 90)))]
    texts += [(102, " ".join(prose(64, 500) + items[1][1].split())), (103, items[4][1]), (104, " ".join(one[:15])), (105, None), (106, ""), (107, " . ")]
    texts += [(None, " ".join(one)), (108, " ".join(prose(65, 40) + prose(53, 30)))]
    docs = frame(spark, texts)
    bench = spark.createDataFrame([(*i, 1.0) for i in items], "item_id long, text string, coverage double")
    got = {(r.doc_id, r.item_id) for r in decontamination.leaks(docs, bench).collect()}
    assert got == {(100, 1), (101, 1), (102, 2), (103, 5), (None, 1), (108, None)}
    stay = decontamination.without_leaks(docs, bench)
    assert stay.columns == docs.columns
    assert {r.doc_id for r in stay.collect()} == {i for i, _ in texts} - {100, 101, 102, 103, 108}
    assert decontamination.leaks(docs.where("false"), bench).count() == 0 == decontamination.leaks(docs, bench.where("false")).count()


def test_leaks_of_the_given_tables(spark):
    sf = "/root/testdata/sf0.01"
    found = {(r.doc_id, r.item_id) for r in queries.op8_benchmark_decontamination(spark, sf).collect()}
    exact = set(duckdb.sql(f"select doc_id, item_id from '{sf}/documents.parquet' d join '{sf}/benchmark.parquet' b on contains(lower(d.text), lower(b.text))").fetchall())
    assert len(exact & found) >= 0.97 * len(exact) and len(found - exact) <= 0.05 * len(exact)


# pipeline


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, SF)
        assert after.columns == docs.columns
        ids = {r.doc_id for r in after.select("doc_id").collect()}
        before = {r.doc_id for r in kept.select("doc_id").collect()}
        assert ids <= before, name
        kept = corpus_pipeline.written(after, "test")
    assert decontamination.leaks(kept, spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0
    pieces = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in kept.select("doc_id").collect()}
    labels = dict(duckdb.sql(f"select doc_id, quality from '{SF}/labels.parquet'").fetchall())
    first = corpus_pipeline.STAGES[0][1](spark, docs, SF)
    good = {r.doc_id for r in first.select("doc_id").collect()}
    assert np.mean([(i in good) == (y == 1) for i, y in labels.items()]) > 0.95


def test_pipeline_stages_on_odd_rows(spark):
    """Nulls in every column, empty and long texts, repeated rows and ids, clashing columns, and no rows at all."""
    good = " ".join(prose(900, 300))
    texts = [(1, good), (1, good), (1, " ".join(prose(901, 300))), (2, good), (None, None), (None, good), (3, None), (4, ""), (5, ""), (6, "long word " * 40_000)]
    docs = frame(spark, texts)
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns and after.count() <= len(texts), name
        assert stage(spark, docs.where("false"), SF).count() == 0, name
    stay = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, docs, SF).select("doc_id", "text").collect()]
    assert sorted(i for i, _ in stay if i is not None) == [1, 1, 3, 4, 6] and len([i for i, _ in stay if i is None]) == 2
    assert {t for i, t in stay if i == 1} == {texts[0][1], texts[2][1]}
    first = corpus_pipeline.keep_good(spark, docs, SF)
    assert first.columns == docs.columns and corpus_pipeline.keep_good(spark, docs.where("false"), SF).count() == 0
    packed = corpus_pipeline.pack(spark, docs, SF)
    assert packed.where("doc_id = 3").count() == 1 and corpus_pipeline.pack(spark, docs.where("false"), SF).count() == 0


def test_near_kept_rows_by_id_and_text(spark):
    """Rows of one id with unrelated texts all stay; of a class's texts under its least id one stays."""
    base = prose(33, 300)
    texts = [(5, "a b c d e f g h"), (5, "i j k l m n o p q"), (7, " ".join(base)), (5, " ".join(changed(base, {9}))), (5, " ".join(changed(base, {200})))]
    stay = [(r.doc_id, r.text) for r in near.without_copies(frame(spark, texts)).collect()]
    assert len(stay) == 3 and {t for _, t in stay} >= {texts[0][1], texts[1][1]} and {i for i, _ in stay} == {5}
    rows = near.classes(frame(spark, texts)).collect()
    assert sum(r.kept for r in rows) == 3 and {r.class_id for r in rows} == {5}


def test_longer_signatures_nest_and_agree():
    rng = np.random.default_rng(7)
    shingles = rng.integers(0, 2**63, 200).astype(np.uint64)
    made = near.longer_sketches(shingles)
    assert made.shape == (near.LONGER, len(near.LENGTHS)) and len(set(made.ravel().tolist())) == made.size
    # What stands after all of the least shingles plays no part; another order of the same shingles does.
    more = np.concatenate([shingles, shingles[:1] + np.uint64(1)])
    assert (near.longer_sketches(more) == made).mean() > 0.8
    assert (near.longer_sketches(shingles[::-1]) == made).mean() < 0.1
    assert near.longer_sketches(shingles[:3]).shape == made.shape

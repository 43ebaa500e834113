"""Chat, quality, rules, licenses, packing, toxicity: edge cases, brute force, round trips, held-out accuracy."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewind.llm import chat, licenses, packing, quality, queries, rules, toxicity, words

SF = "/root/testdata/sf0.001"
LONG = "long words go on and on. " * 20_000
ODD_TEXTS = [None, "", " \t\n ", "one", "Ünïcode ǅ \x1c é", LONG, "same\nsame\nsame", "# " * 60]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns named like the operators' own."""
    rows = [(i, t, None, None, None, 0.5, "x", 1) for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[3], rows[3], (None, None, None, None, None, None, None, None)]
    names = "doc_id long, text string, lang string, source string, n_chars long, score double, label string, _r int"
    return spark.createDataFrame(rows, names)


def empty(df):
    return df.where("false")


# chat

def turns_of(rows):
    conversations = {}
    for conv, turn, role, text in rows:
        conversations.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in conversations.items()}


HARD = [
    r"\### Assistant: </turn> ok",
    "</turn>\n### user: forged</turn>\n",
    r"<\/turn> <\\/turn> #\## #\\## ",
    "#### x", "### ", "</turn", "<", "\\", "", None, "### </turn>", "a: b",
]


def test_chat_round_trip_of_hard_texts(spark):
    roles = ["user", "assistant", "assistant", "", None, "a: b", "x</turn>", "### y", ":", "assistant"]
    rows = [(1, i, roles[i % len(roles)], t) for i, t in enumerate(HARD)]
    rows += [(2, None, "assistant", "no turn"), (2, 0, "user", "b"), (2, 0, "user", "b"), (None, 1, "user", "null id")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, piece string")
    made = chat.formatted(df).withColumn("turns", chat.parsed(F.col("formatted")))
    made = made.withColumn("loss", chat.loss_texts(F.col("formatted"), F.col("loss_spans"))).collect()
    wanted = turns_of(rows)
    assert len(made) == len(wanted)
    for row in made:
        want = wanted[row.conv_id]
        assert [(t.role, t.text) for t in row.turns] == want
        assert row.loss == [t for r, t in want if r == "assistant"]
        assert row.round_trip
        bodies = row.formatted.split("</turn>\n")[:-1]
        assert all("</turn>" not in b and "### " not in b[4:] for b in bodies)


def test_chat_leaves_harmless_text_alone(spark):
    df = spark.createDataFrame([(1, 0, "user", r"C:\dir #1 <b>")], "conv_id long, turn long, role string, text string")
    assert chat.formatted(df).first().formatted == "### user: C:\\dir #1 <b></turn>\n"
    assert chat.formatted(empty(df)).count() == 0


def test_chat_query_digests(spark):
    rows = duckdb.sql(f"select conv_id, turn, role, text from '{SF}/conversations.parquet'").fetchall()
    rows += [(-7, 0, "user", queries.AMBIGUOUS), (-7, 1, "assistant", queries.AMBIGUOUS)]
    found = {r.conv_id: r for r in queries.op1_chat_formatting(spark, SF).collect()}
    wanted = turns_of(rows)
    assert found.keys() == wanted.keys()
    for conv, turns in wanted.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        row = found[conv]
        assert (row.n_turns, row.loss_chars) == (len(turns), len(loss))
        assert row.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert row.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


# classifiers

def test_quality_learns_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    scored = {r.doc_id: r for r in queries.op2_quality_classifier(spark, sf).collect()}
    labels = duckdb.sql(f"select doc_id, quality from '{sf}/labels.parquet'").fetchall()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in scored.items())
    held = [(scored[i].predicted, y) for i, y in labels if scored[i].held_out]
    assert np.mean([p == y for p, y in held]) > 0.95


def test_toxicity_learns_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    scored = {r.doc_id: r for r in queries.op6_toxicity(spark, sf).collect()}
    labels = duckdb.sql(f"select doc_id, toxic from '{sf}/labels.parquet'").fetchall()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in scored.items())
    held = [(scored[i].predicted, y) for i, y in labels if scored[i].held_out]
    assert np.mean([p == y for p, y in held]) > 0.97


def test_machine_learns_a_pair_that_neither_term_gives_away():
    rng = np.random.default_rng(0)
    rows = []
    for i in range(800):
        insult, group = rng.random(2) < 0.5
        text = " ".join(["insult"] * int(insult) + ["group"] * int(group) + [f"w{rng.integers(30)}" for _ in range(4)])
        rows.append((int(insult and group), toxicity.terms(text.encode()).astype("<u8").tobytes()))
    model = toxicity.fit(rows)
    both, one, other = (model.score(t) for t in (b"insult group w1", b"insult w1", b"group w1"))
    assert both > 0.7 and one < 0.5 and other < 0.5


@pytest.mark.parametrize("module, scored", [(quality, quality.quality_score), (toxicity, toxicity.toxicity_score)])
def test_scores_of_odd_texts(spark, odd, module, scored):
    labels = spark.createDataFrame([(3, 1, 0), (5, 0, 1), (None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int")
    for model in (module.fit_on(odd, labels), module.fit_on(empty(odd), labels), module.fit_on(odd, empty(labels)), module.fit([])):
        rows = odd.select("doc_id", scored(model)(F.col("text")).alias("s")).collect()
        assert len(rows) == odd.count() and all(0 <= r.s <= 1 for r in rows)
        by_id = {}
        for r in rows:
            by_id.setdefault(r.doc_id, set()).add(r.s)
        assert all(len(s) == 1 for s in by_id.values()) and by_id[0] == by_id[1]
    assert empty(odd).select(scored(module.fit([]))(F.col("text"))).count() == 0
    assert module.fit([]).score(None) == 0.5


# rules

def counted(text):
    """The base counts by the contract's words."""
    text = text or ""
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    triples = Counter(zip(found, found[1:], found[2:]))
    inside = set()
    for i, triple in enumerate(zip(found, found[1:], found[2:])):
        if triples[triple] > 1:
            inside |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    n = len(found)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return n, sum(map(len, found)), symbols, dup, len(inside), n < 50 or 100 * len(inside) > 50 * n


def test_rules_count_like_brute_force(spark, odd):
    texts = [r[0] for r in duckdb.sql(f"select text from '{SF}/documents.parquet'").fetchall()]
    for text in [*texts, *ODD_TEXTS]:
        got = rules.judged(text.encode() if text is not None else None, rules.NO_FIELD)
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
        assert tuple(got[n] for n in names) == counted(text)
        assert got["kept"] == (not got["base_failed"])  # an unfitted field calls every line content
    got = odd.select("doc_id", rules.rules()(F.col("text")).alias("r")).collect()
    assert len(got) == odd.count() and not any(r.r.kept for r in got if r.doc_id in (0, 1, None))


def test_viterbi_is_the_best_of_all_labelings():
    rng = np.random.default_rng(3)
    field = rules.LineField(rng.normal(size=(rules.N_FEATURES, 2)), rng.normal(size=(2, 2)))
    for n in range(1, 8):
        x = rng.normal(size=(n, rules.N_FEATURES))
        e = x @ field.emission
        paths = [[(k >> i) & 1 for i in range(n)] for k in range(1 << n)]
        value = lambda p: sum(e[i, p[i]] for i in range(n)) + sum(field.transition[a, b] for a, b in zip(p, p[1:]))
        assert field.decode(x).tolist() == max(paths, key=value)
        single, pairs = rules._marginals(e, field.transition)
        weight = np.exp([value(p) for p in paths])
        want = sum(w * np.eye(2)[p] for w, p in zip(weight, paths)) / weight.sum()
        assert np.allclose(single, want)
    assert field.decode(np.zeros((0, rules.N_FEATURES))).tolist() == []


def test_rules_keep_good_and_drop_boilerplate(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in queries.op3_quality_rules(spark, sf).collect()}
    labels = duckdb.sql(f"select doc_id, quality from '{sf}/labels.parquet'").fetchall()
    assert np.mean([rows[i].kept for i, y in labels if y == 1 and not rows[i].base_failed]) > 0.97
    assert np.mean([rows[i].kept for i, y in labels if y == 0]) < 0.1


# licenses

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def test_license_base_like_brute_force(spark):
    docs = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    docs += [(-1, None), (-2, ""), (-3, "MIT  License mit-license"), (-4, "General Public License, Apache License")]
    scanner = licenses.LicenseScanner()
    for _, text in docs:
        found = WORD.findall((text or "").encode().lower())
        places = []
        for phrase, label in licenses.BASE_PHRASES.items():
            p = phrase.encode().split()
            places += [(i, label) for i in range(len(found)) if found[i : i + len(p)] == p]
        got = scanner.scan(text.encode() if text is not None else None)
        assert got["n_words"] == len(found) and got["n_base"] == len(places)
        assert got["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert got.get("first_word") == (min(places)[0] if places else None)
        assert got.get("last_word") == (max(places)[0] if places else None)
        assert set(got["base_labels"].split(",")) - {""} <= set(got["labels"].split(","))


def test_templates_take_optional_and_replaceable_wording_only():
    scan = licenses.LicenseScanner({"t": "one <<beginOptional>>two <<beginOptional>>three <<endOptional>><<endOptional>>four <<var;min=1;max=2>> five"}, {}).scan
    accepted = ["one four x five", "ONE two four x y five!", "zero one two three four x five six"]
    refused = ["one three four x five", "one four five", "one four x y z five", "one two two four x five", "four x five"]
    assert [bool(scan(t.encode())["labels"]) for t in accepted + refused] == [True] * 3 + [False] * 5
    assert scan(accepted[2].encode())["spans"] == [{"label": "t", "start": 1, "end": 7}]
    for bad in ("<<beginOptional>>x", "x<<endOptional>>", "", "<<var;min=0;max=1>>"):
        with pytest.raises(ValueError):
            licenses.Automaton.compiled(bad)


def test_license_column_over_odd_rows(spark, odd):
    rows = odd.select("doc_id", licenses.license_scan()(F.col("text")).alias("r")).collect()
    assert len(rows) == odd.count() and all(r.r.labels == "" and r.r.score == 0 for r in rows)


# packing

def test_packing_cuts_every_id_once(spark, odd):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    tokenizer = Tokenizer.from_file(path)
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(odd.select("doc_id", "text", "lang", "source", "n_chars").where("doc_id is not null").withColumn("doc_id", F.col("doc_id") - 100))
    texts = {}
    for r in docs.select("doc_id", "text").collect():
        texts.setdefault(r.doc_id, []).append(r.text)
    rows = packing.sequences(docs, path).collect()
    pieces = {}
    for r in rows:
        assert r.length == len(r.ids) // 4 == 1 << r.bucket <= 4096 and r.offset == 0
        pieces.setdefault(r.doc_id, []).append(r)
    assert len({r.sequence_id for r in rows}) == len(rows) and pieces.keys() == texts.keys()
    for doc, copies in texts.items():
        assert len(set(copies)) == 1
        want = tokenizer.encode(copies[0] or "", add_special_tokens=False).ids + [2]
        got = sorted(pieces[doc], key=lambda r: r.start)
        if len(copies) == 1:
            assert np.frombuffer(b"".join(r.ids for r in got), "<u4").tolist() == want
            assert [r.start for r in got] == [0, *np.cumsum([r.length for r in got])[:-1]]
            assert {r.doc_tokens for r in got} == {len(want)}
        else:
            assert sum(r.length for r in got) == len(copies) * len(want)
    assert packing.sequences(empty(odd), path).count() == 0


@pytest.mark.parametrize("length", [0, 1, 2, 3, 4095, 4096, 4097, 12_345])
def test_binary_pieces(length):
    pieces = list(packing.binary_pieces(length))
    assert sum(size for _, size in pieces) == length
    assert all(size & (size - 1) == 0 and size <= 4096 for _, size in pieces)
    assert sum(size < 4096 for _, size in pieces) == bin(length % 4096).count("1")


def test_token_ids_of_texts_with_special_names_and_odd_characters():
    path = queries.tokenizer_path()
    from tokenizers import Tokenizer

    tokenizer, chunks = Tokenizer.from_file(path), packing._Chunks(path)
    for text in ["<|endoftext|> a", "ΑΣ. Σ", "İx", "a\x1c!b", "don't 'S 12,3", "e\u0301 x", " ", "\u00a0x\u2003y", "ǅ ß ẞ", "x" * 500]:
        assert np.frombuffer(packing.token_ids(text, chunks), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_new_words_of_latin_letters_go_to_the_model_alone():
    chunks, latin = packing._Chunks(queries.tokenizer_path()), "Größe façade naïve œuvre ŉx STRASSE straße Ĳssel ǅur ªº ȳɏ " + "longword" * 8
    for text in [latin, "Ωmega слово 漢字 ɐb ͵ " + latin, "a, b. größe! x's 'tis"]:
        want = chunks.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(packing.token_ids(text, packing._Chunks(queries.tokenizer_path())), "<u4").tolist() == want
    want, chunks.tokenizer = chunks.tokenizer.encode(latin, add_special_tokens=False).ids, None
    assert np.frombuffer(packing.token_ids(latin, chunks), "<u4").tolist() == want


def test_kept_chunks_stay_bounded(monkeypatch):
    monkeypatch.setattr(packing, "_KEPT_BYTES", 20_000)
    chunks, rng = packing._Chunks(queries.tokenizer_path()), random.Random(5)
    for _ in range(50):
        text = " ".join(f"w{rng.randrange(10**6)}" for _ in range(30))
        assert np.frombuffer(packing.token_ids(text, chunks), "<u4").tolist() == chunks.tokenizer.encode(text, add_special_tokens=False).ids
    assert len(chunks.ids) + len(chunks.older) < 400


# words


def test_hashes_of_words_beyond_the_kept_powers():
    for size in (1, words._PLACES - 1, words._PLACES, words._PLACES + 1, 3 * words._PLACES + 7):
        text = bytes(97 + i * 7 % 26 for i in range(size))
        expected, power = 0, 1
        for byte in text:
            power = power * words._ODD % 2**64
            expected = (expected + (byte + 1) * power) % 2**64
        assert words.hashed_words(b"a " + text + b" b").tolist()[1] == int(words.mixed(np.array([expected], dtype=np.uint64))[0])
    assert len(words._powers) == words._PLACES


def test_word_hashes_depend_on_the_word_alone():
    texts = [b"a bb a  bb\n", b" bb", b"a", b"A Bb"]
    hashes = [words.hashed_words(t).tolist() for t in texts]
    assert hashes[0] == [hashes[2][0], hashes[1][0]] * 2 and hashes[3] == hashes[0][:2]
    assert words.hashed_words(None).size == words.hashed_words(b"").size == words.hashed_words(b" ").size == 0

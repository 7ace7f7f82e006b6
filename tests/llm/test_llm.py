"""The text operators on small tables with nulls, empty and long texts, ties, repeated rows and odd columns."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from cuadra.llm import chat, decontaminate, exact_dedup, ngram_join, packing, quality, simple8b, tokens, toxicity, url_rules, warc  # noqa: E402
from cuadra.llm.common import prepared  # noqa: E402
from cuadra.session import scratch_path, written_once  # noqa: E402

DOCS = "doc_id long, text string, digest string, h int, n int, score int"


def frame(spark, rows):
    """Documents with columns whose names the operators use inside."""
    prepared(spark)
    return spark.createDataFrame([(i, t, "x", 1, 2, 3) for i, t in rows], DOCS)


def some_words(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(n))


LONG = some_words(1, 30_000)


# URL rules

def test_url_rules(spark):
    pages = spark.createDataFrame([
        (1, "http://WWW.Example.ORG/es/1?q#f", "k"), (2, "http://x.example.org/en/12", "k"), (3, "http://example.org", "k"),
        (4, "https://a.com/de/x", "k"), (5, "https://a.com/fr/x", "k"), (6, None, "k"), (7, "nothing", "k"), (8, "", "k"),
        (9, "http://notexample.org/es/1", "k"), (9, "http://notexample.org/es/1", "k"), (None, "http://org/", "k"), (10, "http://organic/", "k"),
    ], "page_id long, url string, key string")
    rules = spark.createDataFrame([*url_rules.RULES, ("example.org", "/es/", "allow"), (None, "/", "block"), ("", "/", "block")],
                                  "host string, path string, verdict string")
    got = sorted(map(tuple, url_rules.judge_urls(pages, rules).collect()), key=repr)
    assert got == sorted([
        (1, "www.example.org", "/es/1", "example.org/es/", "block"), (2, "x.example.org", "/en/12", "example.org/en/1", "block"),
        (3, "example.org", "", None, "allow"), (4, "a.com", "/de/x", "com/de/", "block"), (5, "a.com", "/fr/x", "com/fr/", "allow"),
        (6, "", "", None, "allow"), (7, "", "", None, "allow"), (8, "", "", None, "allow"),
        (9, "notexample.org", "/es/1", "org/", "allow"), (9, "notexample.org", "/es/1", "org/", "allow"),
        (None, "org", "/", "org/", "allow"), (10, "organic", "/", None, "allow")], key=repr)
    assert {r.verdict for r in url_rules.judge_urls(pages, rules.limit(0), "block").collect()} == {"block"}
    assert url_rules.judge_urls(pages.limit(0), rules).count() == 0


# Exact deduplication

def test_exact_dedup(spark):
    rows = [(3, "a b"), (1, "ab"), (2, "a\tb "), (4, None), (5, " \n"), (6, "c"), (None, "c"), (7, LONG), (7, LONG), (8, "A b")]
    index = exact_dedup.DigestIndex(spark, scratch_path(spark, "digests"), buckets=4)
    docs = frame(spark, rows)
    got = {(r.doc_id, r.text_sha256): (r.keep_id, r.group_size, r.kept) for r in exact_dedup.deduplicate(docs, index).collect()}
    sha = lambda t: hashlib.sha256(re.sub("[\x20\x09-\x0d]", "", t).encode()).hexdigest()
    assert got[2, sha("ab")] == (2, 3, True) and got[3, sha("ab")] == (2, 3, False) and got[1, sha("ab")] == (2, 3, False)
    assert got[5, sha("")] == (5, 2, True) and got[4, sha("")] == (5, 2, False)
    assert got[6, sha("c")] == (6, 2, True) and got[None, sha("c")] == (6, 2, False)
    assert got[7, sha(LONG)] == (7, 2, True)
    # What is in the index stays there; a second batch keeps only what is new, and adding it twice changes nothing.
    again = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup.deduplicate(frame(spark, [(50, "a  b"), (51, "new")]), index).collect()}
    assert again == {50: (2, False), 51: (51, True)}
    assert exact_dedup.deduplicate(frame(spark, [(51, "new")]), index).first().kept is False
    n = index.table().count()
    exact_dedup.deduplicate(docs.limit(0), index)
    assert index.table().count() == n
    index.close()


def test_drop_copies_keeps_one_of_repeated_rows(spark):
    docs = frame(spark, [(1, "a"), (1, "a"), (1, "other"), (2, "a"), (3, "b"), (None, None)])
    left = exact_dedup.drop_copies(docs, exact_dedup.DigestIndex(spark, scratch_path(spark, "digests"), buckets=2))
    assert left.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == [(1, "a"), (1, "other"), (3, "b"), (None, None)]


# Tokens

@pytest.fixture(scope="module")
def encoders():
    return [tokens.Encoder(public_tokenizers.path(f), p) for f, p in (("word_bpe_49k.json", tokens.words), ("byte_bpe_50k.json", tokens.spaced))]


@settings(max_examples=150, deadline=None)
@given(st.text() | st.text(st.sampled_from("aB'sLl tT \n\t.,!19éÉ́ßΣς\x1c\x85  <|>中")))
def test_pieces_give_the_ids_of_the_whole_text(encoders, text):
    for e in encoders:
        want = np.array(e.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert e.encode(text) == want


def test_special_tokens_in_a_text(encoders):
    assert np.frombuffer(encoders[1].encode("a<|endoftext|>b"), "<u4")[1] == 50256


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 70_000), st.integers(0, 2**64 - 1)), max_size=300), st.data())
def test_simple8b_round_trip(values, data):
    v = np.array(values, np.uint64)
    coded, escaped = simple8b.pack(v)
    assert (simple8b.unpack(coded, escaped, len(v)) == v).all()
    a = data.draw(st.integers(0, len(v)))
    b = data.draw(st.integers(a, len(v)))
    assert (simple8b.Block(simple8b.write_block([1], [v])).ids(a, b) == v[a:b]).all()


def test_id_file(spark, encoders):
    rows = [(5, "the end"), (2, None), (9, ""), (2, "twice"), (None, "no id"), (7, LONG)]
    path = scratch_path(spark, "ids")
    simple8b.write_ids(frame(spark, rows), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2, block_ids=100)
    got = sorted(simple8b.read_ids(spark, path, with_ids=True).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, 2, 2, 5, 7, 9]
    at = 0
    for r in got:
        assert (r.start, r.n_tokens) == (at, len(r.ids)) and r.ids[-1] == 2
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens
    empty = scratch_path(spark, "ids")
    simple8b.write_ids(frame(spark, rows).limit(0), empty, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    assert simple8b.read_ids(spark, empty).count() == 0


# Packing

@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_best_fit_takes_the_tightest_sequence(lengths):
    size, want, room = 64, {}, []
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    for i in order:
        fits = [(r, k) for k, r in enumerate(room) if r >= lengths[i]]
        best = min(fits)[0] if fits else size
        want.setdefault(i, size - best)
        if fits:
            room[min(fits)[1]] -= lengths[i]
        else:
            room.append(size - lengths[i])
    sequence, offset = packing.best_fit(np.array(lengths, int), size)
    assert len(set(sequence)) == len(room)
    assert [int(x) for x in offset] == [want[i] for i in range(len(lengths))]


def test_packed_documents(spark):
    docs = frame(spark, [(1, LONG), (2, None), (3, ""), (3, ""), (None, "short text"), (4, some_words(2, 900))])
    got = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), size=256).collect()
    by, sequences = {}, {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert [(r.start, r.length) for r in by[2]] == [(0, 1)] and len(by[3]) == 2 and None in by
    for k, r in enumerate(sorted(by[1], key=lambda r: r.piece)):
        assert r.piece == k and (r.length == 256 or k == 0)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256
    assert packing.pack_documents(docs.limit(0), public_tokenizers.path("byte_bpe_50k.json")).count() == 0


# Toxicity and quality

def labelled(n, seed):
    """Half of the texts with words that occur nowhere else, or with a clear mark."""
    r = random.Random(seed)
    plain = [some_words(seed * 1000 + k, 40) for k in range(n)]
    bad = ["zorgwick", "quaxlumpf", "vintrogue"]
    return [(t, 0) if k % 2 else (" ".join(w if r.random() > 0.15 else r.choice(bad) for w in t.split()), 1) for k, t in enumerate(plain)]


def test_toxicity(spark):
    model = toxicity.fit(labelled(160, 1))
    rest = labelled(60, 2)
    score = model.scores([t for t, _ in rest])
    assert sum((s >= 0.5) == bool(y) for s, (_, y) in zip(score, rest)) >= 57
    docs = frame(spark, [(1, None), (2, ""), (2, ""), (3, LONG), (None, LONG + " zorgwick quaxlumpf vintrogue" * 3)])
    left = toxicity.reject(docs, model)
    assert left.columns == docs.columns and sorted(left.select("doc_id").collect(), key=repr) == [(1,), (2,), (2,), (3,)]
    assert toxicity.reject(docs.limit(0), model).count() == 0
    assert toxicity.fit([]).scores(["", "a"]) == [0.5, 0.5]


def test_toxicity_without_evidence_and_with_a_cut_sample(spark):
    docs, sample = frame(spark, [(1, "a b"), (2, None), (3, "zorgwick")]), labelled(160, 1)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    noise = [(t, y) for t, _ in sample for y in (0, 1)]
    for model in (toxicity.train(docs, labels), toxicity.fit([r for r in sample if r[1]]), toxicity.fit(noise)):
        assert toxicity.reject(docs, model).count() == 3
    even, rare = toxicity.fit(sample), toxicity.fit(sample, (9000, 1000))
    plain = [t for t, y in labelled(20, 3) if not y][0]
    assert rare.scores([plain])[0] < even.scores([plain])[0]
    many = spark.createDataFrame([(k, int(k % 10 == 0)) for k in range(1000)] + [(5000, 1), (None, 1)], "doc_id long, toxic int")
    ids = [k for k in range(1000) if zlib.crc32(str(k).encode()) % 5]
    assert toxicity.class_counts(frame(spark, [(k, "x") for k in range(1000)]), many, "toxic") == (
        sum(k % 10 != 0 for k in ids), sum(k % 10 == 0 for k in ids))


def test_labels_of_the_held_out_fold_are_not_read(spark):
    docs = frame(spark, [(i, f"text {i}") for i in range(200)])
    labels = spark.createDataFrame([(i, i % 2) for i in [*range(200), 7, 999]] + [(None, 1), (3, None)], "doc_id long, toxic int")
    got = toxicity.labelled_sample(docs, labels, "toxic", 1000, 1000)
    want = {(f"text {i}", i % 2) for i in range(200) if zlib.crc32(str(i).encode()) % 5}
    assert set(got) == want and len(got) == len(want)
    assert len(toxicity.labelled_sample(docs, labels, "toxic", 10, 1000)) == 20


def test_quality_network(spark, monkeypatch):
    good = [(some_words(k, 60), 1) for k in range(40)]
    bad = [(" | ".join(some_words(100 + k, 60).split()), 0) for k in range(40)]
    monkeypatch.setattr(quality, "STEPS", 60)
    net = quality.fit(good + bad)
    assert net.score(some_words(900, 400)) > 0.5 > net.score(" | ".join(some_words(901, 400).split()))
    # The bad part counts wherever it stands, and slabs do not change a score.
    assert net.score(some_words(902, 40_000)[:200_000] + bad[0][0] * 3) < net.score(some_words(902, 40_000)[:200_000])
    before = net.score(LONG)
    monkeypatch.setattr(quality, "_SLAB", 1 << 12)
    assert abs(net.score(LONG) - before) < 1e-4
    docs = frame(spark, [(1, None), (2, ""), (2, ""), (None, LONG)])
    rows = quality.add_score(docs, net).collect()
    assert len(rows) == 4 and all(0 <= r.score <= 1 for r in rows)
    assert quality.fit([("a", 1)]).score("b") == pytest.approx(2 / 3)


def test_echoes_mark_repetitions():
    assert quality.echoes(np.frombuffer(b"abcdabcd", np.uint8))[:, 0].tolist() == [0, 0, 0, 0, 0, 0, 0, 1]


# N-gram join

def brute_components(rows):
    sets, parent = {}, {}
    for k, (_, t) in enumerate(rows):
        w = re.findall("[^\x20\x09-\x0d]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[k] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
        parent[k] = k

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in sets:
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                parent[max(top(a), top(b))] = min(top(a), top(b))
    return sets, [top(k) for k in sets]


def near_rows():
    r, rows = random.Random(3), []
    for family in range(12):
        base = some_words(family, 40 + 12 * family).split()
        for _ in range(6):
            copy = list(base)
            for _ in range(r.randrange(5)):
                copy[r.randrange(len(copy))] = f"edit{r.randrange(10**6)}"
            rows.append(" ".join(copy[:len(copy) - r.randrange(12)]))
    passage = some_words(99, 30)
    rows += [f"{some_words(500 + k, 50)} {passage}" for k in range(8)]
    rows += [None, "", "  \n", "one two", "ONE  two", "one two three", LONG, LONG + " tail", "a b c d e", "a b c d e"]
    return list(enumerate(rows))


@pytest.mark.parametrize("slice_size", [1 << 17, 300])
def test_near_components(spark, monkeypatch, slice_size):
    monkeypatch.setattr(ngram_join, "SLICE", slice_size)
    rows = near_rows()
    sets, top = brute_components(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_components(frame(spark, rows)).collect()}
    assert got == {i: (len(sets[i]), top[i]) for i, _ in rows}


def test_near_copies_dropped(spark):
    docs = frame(spark, [(5, LONG), (2, LONG + " x"), (2, LONG + " x"), (7, None), (8, ""), (None, LONG)])
    left = ngram_join.drop_near_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [2, 2, 7, 8]
    assert ngram_join.near_components(docs.limit(0)).count() == 0


def test_shingles_do_not_depend_on_their_place():
    s = ngram_join.Shingler()
    a, b = s.hashes("x y z v w q"), s.hashes("start again X Y\tz v w q")
    assert len(a) == 2 and len(b) == 4 and set(a.tolist()) < set(b.tolist())


# Decontamination

def test_decontamination(spark):
    one = some_words(11, 30)
    two = "The shop of Maria sells 12 apples and 7 pears for 12 euros on day 7 of the month, how many are left at night"
    items = spark.createDataFrame([(1, one, 0), (2, two, 0), (3, None, 0), (4, "", 0), (5, "short item here", 0), (1, one, 0)],
                                  "item_id long, text string, windows int")
    changed = two.replace("12", "34").replace("7", "9")
    torn = two.replace("12 apples", "34 apples").replace("12 euros", "56 euros").replace("7", "9")
    words = one.split()
    docs = frame(spark, [
        (1, some_words(21, 50) + ". " + one.upper() + ". " + some_words(22, 50)), (2, changed), (3, torn), (4, some_words(23, 80)),
        (5, " ".join(words[:20])), (6, " ".join(words[:9]) + " " + some_words(24, 60)), (7, None), (8, ""), (9, "short item here"),
        (10, f"{LONG} {one}"), (1, some_words(25, 60)), (None, one)])
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_items(docs, items).collect()}
    assert got == {(1, 1), (2, 2), (5, 1), (9, 5), (10, 1), (None, 1)}
    left = decontaminate.drop_contaminated(docs, items)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [3, 4, 6, 7, 8]
    assert decontaminate.find_items(docs, items.limit(0)).count() == decontaminate.find_items(docs.limit(0), items).count() == 0


def test_short_items_and_items_of_placeholders(spark):
    short, sums = "Who wrote the novel Emma in 1815?", "What is 12 + 7 + 30 + 5 - 8?"
    long_sums = "Add 1 2 3 4 5 6 7 8 9 10 11 12"
    items = spark.createDataFrame([(1, short), (2, sums), (3, long_sums)], "item_id long, text string")
    around = some_words(31, 20), some_words(32, 20)
    docs = frame(spark, [(k, f"{around[0]} {t} {around[1]}") for k, t in enumerate((short, sums, long_sums), 1)] + [
        (4, short), (5, sums), (6, "Add 2 3 5 7 11 13 17 19 23 29 31 37"), (7, "wrote the novel Emma"), (8, " ".join(around))])
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_items(docs, items).collect()}
    assert got == {(1, 1), (2, 2), (3, 3), (4, 1), (5, 2)}


def test_names_and_units_are_found_wherever_they_stand(spark):
    one = "Natalia sold 48 clips in April. Natalia sold 24 in May. How many clips did Natalia sell?"
    two = "The 12-year-old carries 5kg of rice over 3 miles, then rests for a while and walks back home"
    items = spark.createDataFrame([(1, one), (2, two)], "item_id long, text string")
    other = two.replace("12-year", "9-year").replace("5kg", "7 kg").replace("3 miles", "8 km")
    docs = frame(spark, [
        (1, one.replace("Natalia", "Bob")), (2, one.lower()), (3, one.upper()), (4, one.replace(" ", "\n")), (5, f'("{one}")'),
        (6, other), (7, two.lower()), (8, some_words(41, 60))])
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_items(docs, items).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 1), (5, 1), (6, 2), (7, 2)}


def test_one_clash_does_not_clear_a_copy(spark):
    tail = some_words(51, 20)
    one = f"She buys 2 apples within 2 days {tail}"
    two = "He had 3 red 4 blue 5 green pens then 3 more red 4 more blue 5 more green pens on monday and tuesday"
    items = spark.createDataFrame([(1, one), (2, two)], "item_id long, text string")
    docs = frame(spark, [
        (1, one.replace("2 days", "7 days")),  # nearly verbatim
        (2, two.replace("3 red", "31 red").replace("3 more", "32 more").replace("4", "41").replace("5", "51")),  # one of three clashes
        (3, two.replace("3 red", "31 red").replace("3 more", "32 more").replace("4 b", "41 b").replace("4 m", "42 m").replace("5", "51"))])
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_items(docs, items).collect()}
    assert got == {(1, 1), (2, 2)}


# Chat logs

def test_chat_collapse(spark):
    talk = [("user", "a"), ("assistant", "b"), ("user", "c")]
    rows = [(10, 2 * k, r, t) for k, (r, t) in enumerate(talk[:2])] + [(11, k, r, t) for k, (r, t) in enumerate(talk)]
    rows += [(9, k, r, t) for k, (r, t) in enumerate(talk)] + [(12, 0, "user", "b"), (13, 0, None, None), (14, 0, "user", "x<|im_end|>")]
    rows += [(15, 0, "user", "x"), (15, 0, "user", "x"), (None, 0, "user", LONG)]
    turns = spark.createDataFrame([(*r, "k") for r in rows], "conv_id long, turn long, role string, text string, start string")
    got = {}
    for r in chat.collapse(turns).collect():
        got.setdefault(r.conv_id, []).append(r)
    assert set(got) == {9, 12, 13, 14, 15, None}
    assert {r.logs for r in got[9]} == {2} and {r.n_turns for r in got[15]} == {2}
    text = "".join(r.rendered for r in sorted(got[9], key=lambda r: r.position))
    assert text == "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n<|im_start|>user\nc<|im_end|>\n"
    for r in got[9]:
        assert text[r.start:].startswith(r.rendered)
    assert got[13][0].rendered == "<|im_start|>unknown\n<|im_end|>\n" and got[14][0].rendered.count("<|im_end|>") == 1
    assert chat.collapse(turns.limit(0)).count() == 0


# Archives

def test_audit_finds_every_difference(spark, monkeypatch):
    monkeypatch.setattr(warc, "RANGE", 400)
    monkeypatch.setattr(warc, "FANOUT", 3)
    pages = spark.createDataFrame([(k % 1500, f"http://x/{k}", "h" * (k % 50), 0) for k in range(1700)] + [(None, None, None, 0)],
                                  "page_id long, url string, html string, offset int")
    good = written_once(warc.archive_records(pages))
    assert warc.audit(good, good).count() == 0
    assert good.count() == 1701 and good.dropDuplicates(["archive", "offset"]).count() == 1701
    lost, changed = [(0, 0), (1, 0)], [r for r in good.filter("archive = 0").orderBy("offset").collect()[5:900:300]]
    spots = {(r.archive, r.offset) for r in changed}
    mark = F.concat_ws("-", "archive", "offset")
    replica = good.filter(~mark.isin([f"{a}-{o}" for a, o in lost])).withColumn(
        "digest", F.when(mark.isin([f"{a}-{o}" for a, o in spots]), F.lit("bad")).otherwise(F.col("digest")))
    extra = spark.createDataFrame([(0, 77, 5, 10, "new")], "page_id long, archive long, offset long, length long, digest string")
    got = {(r.archive, r.offset): r.status for r in warc.audit(good, replica.unionByName(extra)).collect()}
    assert got == {**{k: "missing" for k in lost}, **{k: "changed" for k in spots}, (77, 5): "extra"}
    assert warc.audit(good.limit(0), good.limit(0)).count() == 0
    assert {r.status for r in warc.audit(good, good.limit(0)).collect()} == {"missing"}


# Pipeline

def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    near = some_words(7, 60)
    item = some_words(8, 20)
    plain = labelled(120, 1)
    rows = [(k, t, "en") for k, (t, _) in enumerate(plain)]
    rows += [(500, near, "en"), (501, near + " more", "de"), (502, near.replace(" ", "  "), None), (503, f"{some_words(9, 50)} {item}", "en"),
             (504, None, "en"), (505, "", None), (None, some_words(10, 30), "en")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, y, y) for k, (_, y) in enumerate(plain)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = written_once(stage(spark, docs, str(tmp_path)))
        if name != "packing":
            assert out.columns == docs.columns
        kept.append({r.doc_id for r in out.collect()})
        docs = out
    toxic, exact, similar, clean, packed = kept
    assert sum(k in toxic for k, (_, y) in enumerate(plain) if y) <= 6
    assert all(k in toxic for k, (_, y) in enumerate(plain) if not y) and {500, 501, 502, 503, 504, 505, None} <= toxic
    assert toxic - exact == {500, 505} and exact - similar == {502} or exact - similar == {501}
    assert similar - clean == {503} and packed == clean
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == packed

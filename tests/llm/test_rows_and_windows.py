"""Rows without ids, with shared ids and with odd columns through the pipeline; template windows against brute force."""

import random
from collections import defaultdict

import regex

import corpus_pipeline
from cuadra.llm import decontaminate, exact_dedup, ngram_join
from cuadra.llm.common import prepared
from cuadra.session import scratch_path, written_once


def some_words(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(n))


def frame(spark, rows, columns="doc_id long, text string, _gone_doc_id int, gone_doc_id int, row_key string, text_md5 string, k int, c int, id int"):
    prepared(spark)
    return spark.createDataFrame([(i, t, 1, 2, "r", "m", 3, 4, 5) for i, t in rows], columns)


# Windows by hand

def words_by_hand(text):
    text = text or ""
    for h in "-‐‑‒–—−":
        text = text.replace(h, " ")
    text = regex.sub(r"[^\p{L}\p{N}\p{M}\s_]+", "", text)
    text = regex.sub(r"(\p{N})(?=\p{L})", r"\1 ", text)
    plain = text.split()
    typed = []
    for w in plain:
        if regex.fullmatch(r"\p{Lu}[\p{Ll}\p{M}]+", w):
            typed.append("_name_")
        elif regex.fullmatch(r"\p{N}+", w):
            typed.append("_number_")
        elif typed and typed[-1] == "_number_" and w.lower() in decontaminate.UNITS:
            typed.append("_unit_")
        else:
            typed.append(w.lower())
    return typed, [w.lower() for w in plain]


def items_by_hand(docs, items, width=8, least=0.4):
    """All windows of all items against all documents; for items whose slots do not repeat a value."""
    found = {}
    by_id = defaultdict(list)
    for i, t in docs:
        by_id[i].append(words_by_hand(t))
    for item, text in items:
        typed, plain = words_by_hand(text)
        w = min(width, len(plain))
        if not w:
            continue
        for doc, texts in by_id.items():
            seen, windows = 0, 0
            have = {tuple(c[i:i + w]) for t in texts for c in t for i in range(len(c) - w + 1)}
            for at in range(len(plain) - w + 1):
                t, p = tuple(typed[at:at + w]), tuple(plain[at:at + w])
                usable = [x for x in {t, p} if x == p and t != p or 2 * sum(y in ("_name_", "_number_", "_unit_") for y in x) <= w]
                windows += bool(usable)
                seen += any(x in have for x in usable)
            if windows and seen / windows >= least:
                found[doc, item] = seen, windows
    return found


def test_windows_against_brute_force(spark):
    r = random.Random(6)
    words = ["der", "zug", "fährt", "Maria", "Köln", "kg", "km", "apples", "x-ray", "don't"]

    def text(n):
        numbers = iter(r.sample(range(10, 10_000), n))
        return " ".join(str(next(numbers)) if r.random() < 0.15 else r.choice(words) + str(next(numbers)) * (r.random() < 0.6) for _ in range(n)) if n else ""

    items = [(k, text(r.choice([0, 1, 3, 7, 8, 9, 20, 30]))) for k in range(25)] + [(None, some_words(3, 12)), (99, None)]
    # Names may repeat in an item; a second name would be a repeated slot, so each item has its own words for them.
    items = [(k, t and t.replace("Maria", f"maria{k}").replace("Köln", f"köln{k}")) for k, t in items]
    docs = []
    for k in range(80):
        t = r.choice(items)[1] or ""
        piece = t.split()
        a, b = sorted(r.choices(range(len(piece) + 1), k=2)) if r.random() < 0.6 else (0, len(piece))
        middle = " ".join(piece[a:b])
        docs.append((k % 70, f"{text(r.randrange(0, 30))} {middle} {text(r.randrange(0, 30))}"))
    docs += [(200, ""), (201, None), (None, some_words(3, 12)), (None, "nothing of it")]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {(x.doc_id, x.item_id): (x.windows, x.item_windows) for x in decontaminate.find_items(frame(spark, docs), table).collect()}
    assert got == items_by_hand(docs, items) and len(got) > 20 and (None, None) in got


def test_window_hashes_of_every_width(spark):
    df = spark.createDataFrame([([1, 2, 3, 1, 2, 3, 1, 2, 3, 4],), ([],), ([5],)], "w array<long>")
    rows = decontaminate.with_windows(df, "w", range(1, 9)).collect()
    for r in rows:
        for width in range(1, 9):
            got = r[f"w_{width}"]
            runs = [tuple(r.w[i:i + width]) for i in range(len(r.w) - width + 1)]
            assert len(got) == len(runs)
            assert len(set(zip(runs, got))) == len(set(runs)) == len(set(got))


# Rows

def test_clean_rows_stay(spark):
    item, near = some_words(1, 30), some_words(2, 60)
    items = spark.createDataFrame([(1, item), (2, None), (None, "")], "item_id long, text string")
    rows = [(None, f"{some_words(3, 40)} {item}"), (None, some_words(4, 40)), (7, some_words(5, 40)), (7, f"{item} {some_words(6, 40)}"), (8, None), (None, "")]
    docs = frame(spark, rows)
    left = decontaminate.drop_contaminated_texts(docs, items)
    assert left.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == sorted((rows[i] for i in (1, 2, 4, 5)), key=repr)
    rows = [(1, near), (None, near + " more"), (None, some_words(7, 50)), (None, some_words(8, 50)), (9, near + " yet more"), (9, some_words(9, 50)),
            (None, some_words(10, 60)), (None, some_words(10, 60) + " end"), (4, ""), (5, None)]
    docs = frame(spark, rows)
    left = ngram_join.drop_near_copies_rows(docs)
    assert left.columns == docs.columns
    got = [(r.doc_id, r.text) for r in left.collect()]
    assert sum(r in got for r in rows[6:8]) == 1
    assert sorted((r for r in got if r not in rows[6:8]), key=repr) == sorted((rows[i] for i in (0, 2, 3, 5, 8, 9)), key=repr)
    assert decontaminate.drop_contaminated(docs, items).count() == len(rows)
    assert exact_dedup.drop_copies(docs, exact_dedup.DigestIndex(spark, scratch_path(spark, "digests"))).count() == len(rows) - 1


def test_pipeline_with_repeated_rows_and_odd_columns(spark, tmp_path):
    rows = [(1, some_words(1, 40)), (1, some_words(1, 40)), (None, some_words(2, 40)), (None, some_words(2, 40)), (2, ""), (3, None), (4, some_words(3, 9000))]
    table = frame(spark, rows)
    folder = str(tmp_path)
    table.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written_once(stage(spark, docs, folder))
        assert docs.columns == table.columns, name
    assert sorted(((r.doc_id, r.text) for r in docs.collect()), key=repr) in (
        sorted([rows[0], rows[2], rows[4], rows[6]], key=repr), sorted([rows[0], rows[2], rows[5], rows[6]], key=repr))
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in docs.collect()}


def test_pipeline_of_an_empty_table(spark, tmp_path):
    folder = str(tmp_path)
    frame(spark, []).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


# Token files, end to end

def test_token_file_rows_are_those_of_the_library(spark):
    import zlib

    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    from cuadra.llm import simple8b

    path = public_tokenizers.path("word_bpe_49k.json")
    rows = [(5, "Der Zug fährt, um 12:30 Uhr!"), (2, "don't   stop\tnow"), (9, None), (1, ""), (7, "a <|endoftext|> b"), (8, "x\x1cy z\x85w"), (3, some_words(5, 4000)),
            (6, "ÀÉÎ naïve œuvre"), (4, "  lead and trail  "), (10, "同じ 言葉 😀 mixed"), (11, "don't   stop\tnow")]
    folder = scratch_path(spark, "ids")
    simple8b.write_ids(frame(spark, rows).repartition(3), folder, path, end_id=2)
    got = sorted(tuple(r) for r in simple8b.read_ids(spark, folder).collect())
    tokenizer, want, start = Tokenizer.from_file(path), [], 0
    for doc, text in sorted(rows):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((doc, start, len(ids), zlib.crc32(ids)))
        start += len(ids)
    assert got == want


def test_known_words_are_forgotten_without_harm():
    import public_tokenizers
    import pyarrow as pa

    from cuadra.llm import tokens

    path = public_tokenizers.path("word_bpe_49k.json")
    encoder = tokens.Encoder(path, tokens.words)
    few = tokens.WordIds(encoder, most=5)
    texts = [some_words(k, 30) + " the cat" for k in range(20)] + ["", " "]
    got = [run.tobytes() for k in range(0, len(texts), 3) for run in few.encode(pa.array(texts[k:k + 3]))]
    assert got == [encoder.encode(t) for t in texts]


# Tiles

def test_many_short_rows_that_share_most_words(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "ROWS", 64)
    shared = "one two three four five six seven"
    docs = frame(spark, [(i, f"{shared} tail{i}") for i in range(400)] + [(1000, f"{shared} tail7")])
    got = {r.doc_id: r.component_id for r in ngram_join.near_components(docs).collect()}
    assert got == {i: i for i in range(400)} | {1000: 7}


def test_a_tile_of_short_rows():
    import numpy as np
    import pandas as pd

    rows = pd.DataFrame({"side": 0, "n": 4, "comp": np.arange(300), "common": [np.array([1, 2, 3, 10 + k // 2]) for k in range(300)]})
    found = ngram_join._tile(rows)
    assert sorted(map(tuple, found.to_numpy().tolist())) == [(2 * k, 2 * k + 1) for k in range(150)]

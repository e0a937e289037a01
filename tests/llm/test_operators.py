"""The training-data operators on small frames, next to brute-force versions."""

import base64
import glob
import hashlib
import random
import tempfile
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from zonepulse.llm import ann, langid, licences, neardup, packing, pieces, sharding, topk, toxicity, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, node long, score double"
FOLDER = "/root/testdata/sf0.001"
PROSE = [
    "the quick brown fox jumps over the lazy dog while the old farmer counts his sheep and sings a very long song about rain",
    "der alte mann und das meer sind nicht immer einer meinung aber die sonne scheint doch jeden tag auf beide herunter ja",
]


def docs_of(frame, texts):
    return frame([(n, t, "en", "s", None, 5, 0.5) for n, t in enumerate(texts)], DOCS)


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


# --- near duplicates ------------------------------------------------------------------------


def test_similar_pairs_equal_full_table():
    draw = random.Random(1)
    pairs = []
    for _ in range(200):
        a = [draw.randrange(6) for _ in range(draw.randrange(1, 60))]
        b = list(a)
        for _ in range(draw.randrange(14)):
            at = draw.randrange(len(b) + 1)
            b[at : at + draw.randrange(2)] = [draw.randrange(6)] * draw.randrange(2)
        pairs.append((np.array(a, np.uint64), np.array(b, np.uint64)))
    want = [edit(a.tolist(), b.tolist()) <= int(0.2 * max(len(a), len(b)) + 1e-9) for a, b in pairs]
    assert neardup.similar_pairs(pairs, 0.8) == want


def test_near_duplicates_on_edge_cases(spark, frame):
    draw = random.Random(2)
    long = " ".join(draw.choice("abcdefgh") * draw.randrange(1, 9) for _ in range(3000))
    texts = [PROSE[0], PROSE[0].upper() + "!", PROSE[0].replace("farmer", "miller"), PROSE[1], None, None, "", "", "!!", "so", "so", long, long + " end"]
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(docs_of(frame, texts)).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 3, 4: 4, 5: 5, 6: 6, 7: 6, 8: 8, 9: 9, 10: 9, 11: 11, 12: 11}
    assert neardup.near_duplicates(docs_of(frame, [])).count() == 0


def test_near_duplicates_find_all_links_of_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r["doc_id"], neardup.word_codes(r["text"])) for r in docs.collect()]
    classes = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(docs).collect()}
    pairs = [(a, b) for i, a in enumerate(rows) for b in rows[i + 1 :]]
    linked = neardup.similar_pairs([(a[1], b[1]) for a, b in pairs], 0.8)
    top = {k: k for k, _ in rows}

    def root(x):
        return x if top[x] == x else root(top[x])

    for (a, b), yes in zip(pairs, linked):
        if yes:
            x, y = sorted((root(a[0]), root(b[0])))
            top[y] = x
    assert classes == {k: root(k) for k in top}


def some_words(draw, n):
    return [f"w{draw.randrange(900)}" for _ in range(n)]


def changed_words(draw, words, places):
    places = set(places)
    return [f"x{draw.randrange(10**6)}" if n in places else w for n, w in enumerate(words)]


def equals_all_pairs(frame, texts, **options):
    rows = [(n, neardup.word_codes(" ".join(t))) for n, t in enumerate(texts)]
    pairs = [(a, b) for i, a in enumerate(rows) for b in rows[i + 1 :]]
    top = list(range(len(rows)))

    def root(x):
        return x if top[x] == x else root(top[x])

    for (a, b), yes in zip(pairs, neardup.similar_pairs([(a[1], b[1]) for a, b in pairs], 0.8)):
        if yes:
            x, y = sorted((root(a[0]), root(b[0])))
            top[y] = x
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(docs_of(frame, [" ".join(t) for t in texts]), **options).collect()}
    return got == {n: root(n) for n in range(len(rows))}


def test_near_duplicates_that_share_a_passage_of_many_texts(frame):
    draw, texts = random.Random(11), []
    passage = some_words(draw, 12)
    for _ in range(60):
        texts.append(passage + some_words(draw, 18))
        texts.append(changed_words(draw, texts[-1], draw.sample(range(12, 30), 6)))
    assert equals_all_pairs(frame, texts)


def test_near_duplicates_in_a_chain_whose_ends_differ(frame):
    draw, texts = random.Random(12), []
    for _ in range(40):
        first = some_words(draw, 50)
        middle = changed_words(draw, first, range(10))
        texts += [first, middle, changed_words(draw, middle, range(40, 50))]
    assert equals_all_pairs(frame, texts, sketches=1)


def test_near_duplicates_leave_no_shuffle_files(spark, frame):
    def files():
        return set(glob.glob(f"{tempfile.gettempdir()}/blockmgr-*/*/shuffle_*.data"))

    before = files()
    found = neardup.near_duplicates(docs_of(frame, [f"{PROSE[n % 2]} {n} {n * n}" for n in range(200)]))
    for _ in range(40):  # Spark removes them beside the work
        if not files() - before:
            break
        time.sleep(0.5)
    assert not files() - before
    assert found.count() == 200 and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None


def test_word_pairs_are_counted_in_slots(frame):
    texts = [PROSE[0], PROSE[0], None, "", "one two one two one", *(["over and over"] * 300)]
    want = np.zeros(1 << neardup.ORDER_BITS, int)
    for text in filter(None, texts):
        np.add.at(want, neardup.labelled_kmers(neardup.word_codes(text), 2) >> np.uint64(64 - neardup.ORDER_BITS), 1)
    want[neardup.labelled_kmers(neardup.word_codes(""), 2) >> np.uint64(64 - neardup.ORDER_BITS)] += 1
    assert (neardup.slot_counts(docs_of(frame, texts), "text", 0.8) == np.minimum(want, 255)).all() and want.max() == 300


def test_word_pairs_of_all_texts_are_counted(frame, monkeypatch):
    monkeypatch.setattr(neardup, "ORDER_TEXTS", 20)
    texts = [f"often met n{n}" for n in range(300)] + [None] * 100
    grams, words = neardup.order_counts(docs_of(frame, texts), "text", 0.8)
    codes = [neardup.word_codes(text) for text in texts if text]
    every = np.concatenate(codes) >> np.uint64(64 - neardup.WORD_BITS)
    want = np.bincount(every.astype(np.int64), minlength=1 << neardup.WORD_BITS)
    assert (words == (neardup.WORD_STEPS * np.log2(want + 1)).astype(int)).all()
    pair = neardup.labelled_kmers(codes[0], 2)[0] >> np.uint64(64 - neardup.ORDER_BITS)
    assert grams[pair] == 15 and (grams > 0).sum() == 1  # 300 of 400 texts


def test_word_profiles_never_leave_out_a_similar_pair(frame):
    draw, texts = random.Random(17), []
    for n in (1, 5, 40, 400):
        for edits in (0, n // 10, n // 5, n // 4, n):
            words = some_words(draw, n)
            other = changed_words(draw, words, draw.sample(range(n), edits))
            texts += [words, other, other[: n - n // 8], words * 300 if n == 1 else words[n // 4 :] + words[: n // 4]]
    rows = list(enumerate(" ".join(t) for t in texts))
    ids = [(a, b) for a, _ in rows for b, _ in rows if a < b]
    codes = [neardup.word_codes(text) for _, text in rows]
    similar = {p for p, yes in zip(ids, neardup.similar_pairs([(codes[a], codes[b]) for a, b in ids], 0.8)) if yes}
    kept = neardup.may_be_similar(frame(ids, "a long, b long"), frame(rows, "node long, text string"), 0.8).collect()
    assert similar <= {(r["a"], r["b"]) for r in kept} and len(kept) < len(ids) / 2
    assert neardup.may_be_similar(frame([], "a long, b long"), frame(rows, "node long, text string"), 0.8).count() == 0


def test_texts_of_unlike_pairs_do_not_move(spark, frame, monkeypatch):
    draw, sent, verify = random.Random(18), [], neardup.verify
    passage = some_words(draw, 90)
    texts = [" ".join(passage + [f"y{draw.randrange(10**6)}" for _ in range(70)]) for _ in range(40)]
    monkeypatch.setattr(neardup, "verify", lambda pairs, *rest: sent.append(pairs.count()) or verify(pairs, *rest))
    assert len({r["class_id"] for r in neardup.near_duplicates(docs_of(frame, texts), sketches=1).collect()}) == 40
    assert sum(sent) < 100  # each two of them share half their word pairs
    links = neardup._Links(frame(list(enumerate(texts)), "node long, text string"), 0.8)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = links.texts_of(frame([(1, 2)], "a long, b long"))._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_texts_that_share_a_passage_meet_once(frame, monkeypatch):
    draw, made, joined = random.Random(19), [], neardup._joined
    passage = some_words(draw, 90)
    texts = [passage + [f"y{draw.randrange(10**6)}" for _ in range(70)] for _ in range(30)]
    monkeypatch.setattr(neardup, "_joined", lambda few, *rest: made.append(joined(few, *rest).count()) or joined(few, *rest))
    assert equals_all_pairs(frame, texts, sketches=1)
    assert sum(made) <= 2 * 435  # each two of them share 89 word pairs


def test_texts_that_share_a_passage_with_many_are_compared_by_blocks(frame, monkeypatch):
    draw, texts, made, joined = random.Random(20), [], [], neardup._joined
    passage = some_words(draw, 40)
    for n in range(90):
        texts.append(passage + some_words(draw, draw.randrange(6, 16)))
    texts += [changed_words(draw, t, draw.sample(range(len(t)), len(t) // 5)) for t in texts[:20]]
    monkeypatch.setattr(neardup, "_joined", lambda few, *rest: made.append(joined(few, *rest).count()) or joined(few, *rest))
    monkeypatch.setattr(neardup, "MANY", 3)
    monkeypatch.setattr(neardup, "BLOCK", 8)
    assert equals_all_pairs(frame, texts, sketches=1)
    assert sum(made) < 500


def test_first_alignments_cost_no_less_than_the_distance():
    draw, pairs = random.Random(26), []
    for n in range(40):
        for kinds in (3, 30, 10**6):
            words = np.array([draw.randrange(kinds) for _ in range(n)], np.uint64)
            cut, other = draw.randrange(n + 1), words.copy()
            other[draw.sample(range(n), n // 6)] = 1
            pairs += [(words, other), (words, np.r_[other[cut:], other[:cut]]), (other[:cut], words), (np.delete(words, slice(cut, cut + 2)), other)]
    pairs = [(a, b) for a, b in pairs if len(a) + len(b)]
    costs = np.array([neardup._cost(a, b) for a, b in pairs])
    assert (costs >= neardup.banded_distances(pairs, 50)).all()
    words = np.arange(100, dtype=np.uint64)
    assert neardup._cost(words, np.r_[words[:40], words[43:]]) == 3


def test_texts_that_share_one_word_pair_do_not_meet(frame, monkeypatch):
    draw, texts, made, joined = random.Random(22), [], [], neardup._joined
    for n in range(30):
        texts.append([f"y{draw.randrange(10**6)}" for _ in range(40)])
        texts[-1][20:22] = ["one", "pair"]
    texts += [changed_words(draw, t, draw.sample(range(40), 8)) for t in texts[:3]]
    monkeypatch.setattr(neardup, "_joined", lambda few, *rest: made.append(joined(few, *rest).count()) or joined(few, *rest))
    assert equals_all_pairs(frame, texts, sketches=1)
    assert sum(made) <= 3  # any two of them share a word pair, at the same place


def test_near_duplicates_that_share_as_few_word_pairs_as_edits_leave(frame):
    draw, texts = random.Random(23), []
    for n in range(4, 24):
        for _ in range(3):
            words = some_words(draw, n)
            cuts = range(1, n - 1, 2)
            texts += [words, changed_words(draw, words, draw.sample(cuts, min(len(cuts), n // 5)))]
    assert equals_all_pairs(frame, texts, sketches=1)


def test_word_pairs_lie_on_disk_a_slice_at_a_time(frame, monkeypatch):
    draw, texts, kept, stash = random.Random(24), [], [], neardup.stash
    for _ in range(40):
        texts.append(some_words(draw, 50))
        texts.append(changed_words(draw, texts[-1], draw.sample(range(50), 12)))

    def counted(df, label="stash"):
        out = stash(df, label)
        kept.append((label, out.count()))
        return out

    monkeypatch.setattr(neardup, "stash", counted)
    assert equals_all_pairs(frame, texts, sketches=1)
    met = [n for label, n in kept if label == "met"]
    assert len(met) > 1 and 0 < max(met) < sum(met) / 2


def test_blocks_are_compared_some_at_a_time(frame, monkeypatch):
    draw, texts = random.Random(25), []
    passage = some_words(draw, 40)
    for _ in range(40):
        texts.append(passage + some_words(draw, draw.randrange(6, 16)))
    texts += [changed_words(draw, t, draw.sample(range(len(t)), len(t) // 5)) for t in texts[:10]]
    monkeypatch.setattr(neardup, "MANY", 3)
    monkeypatch.setattr(neardup, "BLOCK", 16)
    monkeypatch.setattr(neardup, "BLOCKS_AT_ONCE", 4)
    assert equals_all_pairs(frame, texts, sketches=1)


def test_near_duplicates_with_repeated_and_moved_words(frame):
    draw, texts = random.Random(21), []
    for n in (12, 30, 60):
        for _ in range(25):
            words = [f"w{draw.randrange(9)}" for _ in range(n)]
            cut, put = draw.randrange(n), draw.randrange(n)
            moved = words[:cut] + words[cut + n // 10 :]
            texts += [words, moved[:put] + [f"w{draw.randrange(9)}" for _ in range(n // 10)] + moved[put:]]
    assert equals_all_pairs(frame, texts, sketches=1)


def test_near_duplicates_at_the_threshold(frame):
    draw, texts = random.Random(13), []
    for n in (5, 10, 20, 60, 150):
        for _ in range(20):
            texts.append(some_words(draw, n))
            texts.append(changed_words(draw, texts[-1], draw.sample(range(n), n // 5)))
    assert equals_all_pairs(frame, texts)


def test_pipeline_drops_near_copies_by_slices_and_counts_of_all_texts(spark, frame, monkeypatch):
    draw, texts, kept, seen, stash, counts = random.Random(27), [], [], [], neardup.stash, neardup.order_counts
    for _ in range(40):
        texts.append(some_words(draw, 50))
        texts.append(changed_words(draw, texts[-1], draw.sample(range(50), 9)))

    def counted(df, label="stash"):
        out = stash(df, label)
        kept.append((label, out.count()))
        return out

    monkeypatch.setattr(neardup, "stash", counted)
    monkeypatch.setattr(neardup, "ORDER_TEXTS", 10)
    monkeypatch.setattr(neardup, "order_counts", lambda *args: seen.append(counts(*args)) or seen[-1])
    rows = corpus_pipeline.distinct(spark, docs_of(frame, [" ".join(t) for t in texts]), "").collect()
    assert sorted(r["doc_id"] for r in rows) == [*range(0, 80, 2)]
    met = [n for label, n in kept if label == "met"]
    assert len(met) == neardup.SLICES
    every = np.concatenate([neardup.word_codes(" ".join(t)) for t in texts]) >> np.uint64(64 - neardup.WORD_BITS)
    want = np.bincount(every.astype(np.int64), minlength=1 << neardup.WORD_BITS)
    assert (seen[0][1] == (neardup.WORD_STEPS * np.log2(want + 1)).astype(int)).all()


# --- licences, archives, shards -------------------------------------------------------------


def test_licences_count_phrases(frame):
    texts = ["Released under the MIT License. Mit  license!", "CC BY-NC 4.0; GNU General\nPublic License", "gnu general public", None, "", "licensed under the apache license version 2.0"]
    got = {r["doc_id"]: r for r in licences.licence_scan(docs_of(frame, texts)).collect()}
    assert [got[n]["n_base"] for n in range(6)] == [2, 2, 0, 0, 0, 1]
    assert (got[0]["first_word"], got[0]["last_word"], got[0]["labels"]) == (3, 5, "mit")
    assert (got[1]["base_labels"], got[1]["first_word"], got[1]["last_word"]) == ("cc-by,gpl", 0, 5)
    assert got[3]["n_words"] == 0 and got[3]["first_word"] is None and got[4]["score"] == 0.0
    assert got[5]["labels"] == "apache,apache-2.0" and got[5]["n_words"] == 8
    twice = licences.licence_scan(docs_of(frame, texts).union(docs_of(frame, texts))).collect()
    assert Counter(map(tuple, twice)) == Counter({tuple(r): 2 for r in got.values()})
    assert licences.licence_scan(docs_of(frame, [])).count() == 0


def test_archives_round_trip(spark, frame, tmp_path):
    bodies = ["<p>ä\r\n\r\nWARC/1.1</p>", "b", "<p>ä\r\n\r\nWARC/1.1</p>", None, "", "b"]
    pages = frame([(9 - n, f"http://www.A.b/{n} x", "2024-01-01T00:00:00Z", b) for n, b in enumerate(bodies)], "page_id long, url string, captured string, body string")
    warc.write_archives(pages, str(tmp_path / "w"), records_per_file=2)
    rows = warc.merge_runs(warc.read_runs(spark, str(tmp_path / "w"))).orderBy("part", "place").collect()
    assert [r["urlkey"] for r in rows] == sorted(f"b,a)/{n}%20x" for n in range(6))
    first = {}
    for n, b in sorted(enumerate(bodies), reverse=True):
        first.setdefault(b or "", 9 - n)
    for r in rows:
        body = bodies[9 - r["page_id"]] or ""
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(body.encode()).digest()).decode()
        assert r["payload_bytes"] == len(body.encode())
        assert r["refers_to"] == (None if first[body] == r["page_id"] else first[body])


def test_archives_of_odd_pages(spark, frame, tmp_path):
    schema = "page_id long, url string, captured string, body string, payload_bytes int, refers_to string"
    long = "x\r\n\r\ny" * 300_000
    rows = [(5, "http://a.b/", "2024-01-01T00:00:00Z", "same"), (5, "http://a.b/", "2024-01-01T00:00:00Z", "same"), (None, None, "2024-01-01T00:00:00Z", "same"),
            (7, "http://a.b/7", "2024-01-01T00:00:00Z", "same"), (8, "no url", "2024-01-02T00:00:00Z", long), (9, "http://c.d", "2024-01-01T00:00:00Z", long)]
    pages = frame([(*r, 1, "x") for r in rows], schema)

    def captures(min_bytes):
        path = str(tmp_path / f"w{min_bytes}")
        warc.write_archives(pages, path, min_bytes)
        out = warc.merge_runs(warc.read_runs(spark, path)).collect()
        return Counter((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in out)

    want = Counter({(5, 4, "response", None): 2, (None, 4, "response", None): 1, (7, 4, "revisit", 5): 1, (8, len(long), "response", None): 1, (9, len(long), "revisit", 8): 1})
    assert captures(0) == want
    del want[7, 4, "revisit", 5]
    assert captures(5) == want + Counter({(7, 4, "response", None): 1})
    warc.write_archives(pages.limit(0), str(tmp_path / "none"))
    assert warc.merge_runs(warc.read_runs(spark, str(tmp_path / "none"))).count() == 0


def test_loser_tree_merges_any_number_of_runs():
    draw = random.Random(3)
    for k in range(9):
        runs = [sorted((f"{draw.randrange(20):02}", "", n, 0, "", "", None, "f", 0, 0) for n in range(draw.randrange(8))) for _ in range(k)]
        assert [r[:3] for r in warc.LoserTree(runs)] == sorted(r[:3] for run in runs for r in run)


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2)])
def test_curve_steps_to_neighbours(spark, dims, bits):
    cells = spark.range(1 << bits * dims).select(*[F.expr(f"cast((id div {(1 << bits) ** n}) % {1 << bits} as int)").alias(f"c{n}") for n in range(dims)])
    names = [f"c{n}" for n in range(dims)]
    rows = cells.select(sharding.hilbert_index([F.col(c) for c in names], bits).alias("at"), *names).orderBy("at").collect()
    assert [r["at"] for r in rows] == list(range(len(rows)))
    assert all(sum(abs(x - y) for x, y in zip(a[1:], b[1:])) == 1 for a, b in zip(rows, rows[1:]))


def test_shards_have_equal_rows(frame):
    rows = sharding.hilbert_shards(docs_of(frame, ["ä", None, "", "x" * 50_000] * 5 + [PROSE[0]])).collect()
    per = defaultdict(list)
    for r in rows:
        per[r["shard"]].append(r["slot"])
    assert sorted(map(len, per.values())) == [2] * 3 + [3] * 5 and all(sorted(s) == list(range(len(s))) for s in per.values())
    assert {(r["size"], r["text_crc32"]) for r in rows} == {(len(t.encode()) + 1, zlib.crc32(t.encode())) for t in ("ä", "", "x" * 50_000, PROSE[0])}
    assert sharding.hilbert_shards(docs_of(frame, [])).count() == 0


# --- packing, pieces ------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(4))
def test_plan_places_everything_once(seed):
    draw = random.Random(seed)
    counts = Counter(min(512, max(1, int(draw.lognormvariate(4 + seed / 2, 1)))) for _ in range(3000))
    rows, n = packing.plan_packing(counts, 512)
    filled, placed = defaultdict(list), Counter()
    for length, first, sequence, offset, many in rows.tolist():
        assert first == placed[length]
        placed[length] += many
        for s in range(sequence, sequence + many):
            filled[s].append((offset, length))
    assert placed == counts and sorted(filled) == list(range(n))
    for parts in filled.values():
        ends = [0] + [o + length for o, length in sorted(parts)]
        assert [o for o, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 512
    assert n <= 1.03 * sum(k * v for k, v in counts.items()) / 512 + 2


def test_packing_ids_are_the_tokenizers(spark, frame):
    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    texts = [None, "", "A's b'S don't!! <|endoftext|> É.. \t x\x1cy İstanbul ΣΑΣ. 123.,4 l'été… ́a", "wörd Thing... " * 4000, PROSE[0], PROSE[0]]
    rows = packing.packed_documents(docs_of(frame, texts)).collect()
    for n, text in enumerate(texts):
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 1]
        own = sorted((r for r in rows if r["doc_id"] == n), key=lambda r: r["piece"])
        assert [r["start"] for r in own] == list(range(0, len(ids), 4096))
        for r in own:
            cut = ids[r["start"] : r["start"] + r["length"]]
            assert r["ids_crc32"] == zlib.crc32(np.array(cut, "<u4").tobytes())
    ends = defaultdict(int)
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends[r["sequence_id"]]
        ends[r["sequence_id"]] += r["length"]
    assert max(ends.values()) <= 4096


def test_pieces_equal_the_library(spark, frame):
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["  hello   world\n\tx  ", None, "", " ", "▁a", "ﬁ Ⅷ é 梦😀x", "<s> <0x41>", "x" + " " * 40 + "y", "a" * 60, "=-" * 30, PROSE[1] * 20]
    texts += [r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60).collect()]
    for r in pieces.encode_texts(docs_of(frame, texts), path).collect():
        text = texts[r["doc_id"]] or ""
        ids = model.encode(text)
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids and r["decoded"] == text.replace("▁", " ")


# --- vectors --------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, v int"


def test_top_k_equals_brute_force(frame):
    draw = np.random.default_rng(4)
    rows = [(n, draw.normal(size=20).tolist(), 0) for n in range(300)] + [(300 + n, [0.5] * 20, 0) for n in range(30)]
    odd = [(900, None, 0), (901, [1.0, None], 0), (902, [float("nan")] * 20, 0), (None, [1.0] * 20, 0), (903, [1.0, 2.0], 0), rows[0]]
    vectors = topk.whole_vectors(frame(rows + odd, VECTORS))
    got = defaultdict(list)
    for r in topk.exact_top_k(vectors, vectors.where("vec_id % 100 = 0"), k=10, block=64).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    whole = np.floor(1024 * np.array([e for _, e, _ in rows], np.float32).astype(float)).astype(np.int64)
    for n in (0, 100, 200, 300):
        scores = whole @ whole[n]
        want = [(int(i), int(scores[i])) for i in np.lexsort((np.arange(330), -scores)) if i != n][:10]
        assert got[n] == want


def test_multi_index_recall(frame):
    draw = np.random.default_rng(5)
    data = draw.normal(size=(2000, 16)).astype(np.float32)
    data[1500:] = data[1500]
    rows = [(n, v.tolist(), 0) for n, v in enumerate(data)] + [(5000, [0.0] * 16, 0), (5001, None, 0)]
    vectors = ann.fine_vectors(frame(rows, VECTORS))
    cells, index = ann.build(vectors, k=16)
    got = defaultdict(list)
    for r in ann.search(cells, index, vectors.where(ann.is_query())).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    wide, hits = data.astype(float), []
    for n in range(0, 2000, 20):
        scores = (wide * wide[n]).sum(axis=1)
        want = [i for i in np.lexsort((np.arange(2000), -scores)) if i != n][:20]
        assert all(score == scores[i] for i, score in got[n])
        hits.append(len({i for i, _ in got[n]} & set(want)) / 20)
    assert np.mean(hits) >= 0.9


# --- toxicity, language ---------------------------------------------------------------------


def test_disguised_words_are_restored(frame):
    draw = random.Random(6)
    some = lambda: " ".join(draw.sample(sorted(set(" ".join(PROSE).split())), 20))
    texts = [f"{some()} idiot {some()}" if n % 4 == 0 else some() for n in range(120)]
    docs = docs_of(frame, texts)
    labels = docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    model = toxicity.fit(docs, labels)
    assert {toxicity.decode(t, model) for t in ("1d10t", "i.d.i.o.t", "i d i o t", "iiidiooot")} == {"idiot"}
    got = toxicity.toxicity(docs_of(frame, ["you 1d10t", "what a i d i o t he is", None, "", PROSE[0]]), model).orderBy("doc_id").collect()
    assert [r["predicted"] for r in got] == [1, 1, 0, 0, 0]
    assert toxicity.keep_harmless(docs_of(frame, []), model).columns == docs.columns


def small_model(*weighted):
    words = Counter((" ".join(PROSE[:1]) + " you are an " + " ".join(weighted)).split())
    triples = Counter()
    for word, n in words.items():
        edged = f"\0\0{word}\0"
        triples.update({edged[i : i + 3]: n for i in range(len(edged) - 2)})
    return toxicity.Model(dict(triples), {w: 5.0 for w in weighted}, -5.0)


def test_disguised_ends_of_words_are_decoded():
    model = small_model("ass", "shit", "slut")
    for text in ("what an a$$", "oh shi+", '"$lut"', "(a$$)"):
        assert toxicity.score_text(text, model)[1] == 1, text
    assert toxicity.score_text(PROSE[0] + "! (so) it+ on$", model)[1] == 0


def test_long_stretches_and_sentences_set_apart_are_decoded():
    model = small_model("idiot")
    for text in ("i" * 50 + "d" + "i" * 50 + "ooot", "y o u a r e a n i d i o t", " ".join("you are an " * 5 + "idiot you are").replace("   ", " ")):
        assert toxicity.score_text(text, model)[1] == 1, text
    assert toxicity.score_text(" ".join("thequickbrownfox"), model)[1] == 0


def test_languages_are_told_apart(spark, frame):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.identify(docs.where(langid.held_out()), langid.fit(docs.where(~langid.held_out())))
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97
    model = langid.fit(docs)
    got = langid.identify(docs_of(frame, [None, "", "12 34!", PROSE[0]]), model).orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in got] == ["und", "und", "und", "en"] and got[0]["score"] == 0.0
    assert langid.identify(docs_of(frame, ["a"]), langid.train({})).first()["lang_pred"] == "und"


@pytest.mark.parametrize("n", [1, 2, 4, 7, 20])
def test_codewords_differ(n):
    codes = langid.codewords(n)
    assert len({tuple(c) for c in codes}) == n


# --- pipeline -------------------------------------------------------------------------------


@pytest.mark.parametrize("stage", ["harmless", "identified"])
def test_stages_send_a_text_once_and_keep_other_columns(frame, stage):
    rows = [(2**53 + 1, PROSE[0], "en", "s", 2**53 + 1, None, 0.25), (None, "12 you idiot", None, "s", None, 5, None), (3, "12 34!", "en", None, 1, 5, 0.5)]
    docs = frame(rows, DOCS).coalesce(1)
    if stage == "harmless":
        kept, want = toxicity.keep_harmless(docs, small_model("idiot")), [rows[0], rows[2]]
    else:
        kept, want = langid.keep_identified(docs, langid.train({"en": langid.gram_counts(PROSE[0])})), rows[:2]
    assert kept.schema == docs.schema and [tuple(r) for r in kept.collect()] == want
    # Python gets the text alone and gives a value back: no second copy of the documents in an executor.
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "MapIn" not in plan


def test_stages_get_texts_in_small_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").coalesce(1)
    try:
        for there, then in (("10000", "1000"), ("0", "1000"), ("300", "300")):
            for name, stage in corpus_pipeline.STAGES[:2]:
                spark.conf.set(key, there)
                stage(spark, docs, FOLDER)
                assert spark.conf.get(key) == then, name
    finally:
        spark.conf.set(key, before)


def test_learning_holds_one_text_at_a_time(frame):
    docs = frame([(n, PROSE[n % 2] + " x" * n, ("en", "de")[n % 2], "s", n, 5, 0.5) for n in range(40)], DOCS)
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    model = toxicity.fit(docs, labels)
    want = Counter()
    for body in (r["text"] for r in docs.collect()):
        for word in body.split():
            edged = f"\0\0{word}\0"
            want.update(edged[i : i + 3] for i in range(len(edged) - 2))
    assert model.triples == want
    told = langid.fit(docs)
    counts = {k: sum(langid.gram_counts(r["text"]) for r in docs.where(F.col("lang") == k).collect()) for k in ("en", "de")}
    assert told.languages == ["de", "en"] and np.allclose(told.weights, langid.train(counts).weights)


def test_pipeline_drops_what_its_stages_reject(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, FOLDER)
        assert kept.columns == columns
    rows = corpus_pipeline.run(spark, FOLDER)
    model = toxicity.fit(docs, spark.read.parquet(f"{FOLDER}/labels.parquet").where(~toxicity.held_out()))
    calm = [r for r in docs.collect() if toxicity.score_text(r["text"], model)[0] < toxicity.THRESHOLD]
    classes = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(spark.createDataFrame(calm, docs.schema)).collect()}
    assert {r["doc_id"] for r in rows.collect()} == set(classes.values())

"""Token files, tokenizer alignment and the conversation trie, next to brute-force versions."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from zonepulse.llm import alignment, bytelevel, prefixes, tokenfile

FOLDER = "/root/testdata/sf0.001"
BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, lang string, key string, part int, n_tokens long"
TEXTS = [
    "The quick brown fox, isn't it?\n\n  Two  spaces and a tab\t. ", None, "", " ", "   \n ", "Straße und Çà là 漢字 😀 é", "a", "#",
    "x<|endoftext|>y <s> </s> <0x41>", "a▁b", "  wide　", "naïve 12345 678 !!! don't we'll", "no-break  space ",
    "nul\x00 and \x1c odd", "word " * 3000 + "end", "z" * 5000, "#" * 700,
]


def docs_of(frame, texts):
    return frame([(n, t, "en", "k", 3, 5) for n, t in enumerate(texts)], DOCS)


# --- byte-level ids -------------------------------------------------------------------------


def test_ids_equal_the_library():
    draw = random.Random(1)
    pool = [chr(i) for i in range(1, 0x250)] + list(" \n\t 　 \u0085'") * 20 + ["<|endoftext|>", "漢", "😀", "́", "'s", "'ll", "don't", ").", "foo,"]
    texts = ["".join(draw.choice(pool) for _ in range(draw.randrange(14))) for _ in range(4000)] + [t or "" for t in TEXTS]
    for plain in (False, True):
        library = Tokenizer.from_file(BYTES)
        library.encode_special_tokens = plain
        own = bytelevel.ByteLevel(BYTES, plain)
        for text in texts:
            assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_stretches_are_learned_when_looked_up():
    encoder, library = bytelevel.ByteLevel(BYTES), Tokenizer.from_file(BYTES)
    for part in ("hello", "Straße", "unheardofwordofmanytokensxyzzyq", "end.", "end", "漢字", "a-b", "don't", "12,5"):
        want = np.array(library.encode(" " + part, add_special_tokens=False).ids, "<u4").tobytes()
        assert encoder.stretches[part] == want == encoder.stretches[part]


def test_ids_with_little_memory(monkeypatch):
    monkeypatch.setattr(bytelevel, "REMEMBERED", 3)
    own, library = bytelevel.ByteLevel(BYTES), Tokenizer.from_file(BYTES)
    for text in ["one two, three four. five six seven (eight) nine ", "one two zwölf", "two one. one two, groß", "one two", "six, seven. été"] * 2:
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


# --- token files ----------------------------------------------------------------------------


@pytest.mark.parametrize("bits, n", [(1, 10), (5, 100), (16, 70_000), (17, 40_000), (3, 0), (16, tokenfile.BLOCK)])
def test_wavelet_lookups_equal_the_array(bits, n):
    draw = random.Random(bits)
    ids = np.array([draw.randrange(min(1 << bits, 50)) if draw.random() < 0.5 else draw.randrange(1 << bits) for _ in range(n)], np.int64)
    matrix = tokenfile.WaveletMatrix(tokenfile.pack(ids, bits, {"end": 1}, {"own": np.arange(3)}) + b"\n")
    assert (matrix.ids() == ids).all() and matrix.header["end"] == 1 and matrix.sections["own"].tolist() == [0, 1, 2]
    assert matrix.count(1 << bits) == 0 and matrix.find(1 << bits) == -1
    for _ in range(150 if n else 0):
        token = int(ids[draw.randrange(n)])
        first, last = sorted((draw.randrange(n + 1), draw.randrange(n + 1)))
        assert matrix.count(token, first, last) == int((ids[first:last] == token).sum())
        places = np.flatnonzero(ids == token)
        k = draw.randrange(len(places))
        assert matrix.find(token, k) == places[k] and matrix.access(int(places[k])) == token
        assert matrix.find(token, len(places)) == -1
    for place in (-1, n):
        with pytest.raises(IndexError):
            matrix.access(place)


def test_corpora_of_like_tokens_take_less_room():
    draw = np.random.default_rng(1)
    even, skewed = draw.integers(0, 1 << 16, 200_000), np.minimum(draw.geometric(0.05, 200_000), 60_000)
    assert len(tokenfile.pack(skewed, 16, {}, {})) < 0.6 * len(tokenfile.pack(even, 16, {}, {}))
    with pytest.raises(ValueError):
        tokenfile.WaveletMatrix(b"something else")


@pytest.mark.parametrize("per_file", [40, 1_000_000])
def test_files_give_every_document_back(spark, frame, tmp_path, per_file):
    docs = docs_of(frame, TEXTS).union(frame([(None, "no key", "en", "k", 1, 1), (3, "#", "en", "k", 1, 1), (3, "#", "en", "k", 1, 1)], DOCS))
    tokenfile.write_files(docs, str(tmp_path / "t"), BYTES, per_file=per_file)
    got = tokenfile.with_starts(tokenfile.read_documents(spark, str(tmp_path / "t"))).orderBy("start").collect()
    library = Tokenizer.from_file(BYTES)
    want = Counter((r["doc_id"], np.array(library.encode(r["text"] or "", add_special_tokens=False).ids + [2], "<u4").tobytes()) for r in docs.collect())
    assert Counter((r["doc_id"], bytes(r["ids"])) for r in got) == want
    keys = [r["doc_id"] for r in got]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    at = 0
    for r in got:
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(r["ids"]) // 4, zlib.crc32(r["ids"]))
        at += r["n_tokens"]
    # Lookups over all files, without unpacking them: '#' in a text has the id that ends documents.
    all_ids = [np.frombuffer(r["ids"], "<u4") for r in got]
    counted = {r["token"]: r["n"] for r in tokenfile.count_tokens(spark, str(tmp_path / "t"), [2, 11, 50256]).collect()}
    assert counted == {t: sum(int((ids == t).sum()) for ids in all_ids) for t in (2, 11, 50256)}
    found = tokenfile.find_tokens(spark, str(tmp_path / "t"), 2).collect()
    want = Counter((r["doc_id"], int(p)) for r, ids in zip(got, all_ids) for p in np.flatnonzero(ids == 2))
    assert Counter((r["doc_id"], r["place"]) for r in found) == want


def test_files_of_an_empty_table(spark, frame, tmp_path):
    tokenfile.write_files(frame([], DOCS), str(tmp_path / "t"), BYTES)
    assert tokenfile.with_starts(tokenfile.read_documents(spark, str(tmp_path / "t"))).count() == 0


def test_token_query(spark):
    got = tokenfile.op13_wavelet_shards(spark, FOLDER).orderBy("doc_id").collect()
    library, at = Tokenizer.from_file(BYTES), 0
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect()
    for r, d in zip(got, docs, strict=True):
        ids = np.array(library.encode(d["text"] or "", add_special_tokens=False).ids + [2], "<u4")
        assert tuple(r) == (d["doc_id"], at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


# --- alignment ------------------------------------------------------------------------------


def aligned_by_hand(texts):
    """Per text: ids of both sides, groups of ids by cumulative lengths, and pairs that end together."""
    a = Tokenizer.from_file(BYTES)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    letters = {c: n for n, c in enumerate(bytelevel.byte_letters())}
    out = []
    for text in texts:
        ids_a = a.encode(" " + (text or ""), add_special_tokens=False).ids
        ids_b = b.encode(text or "")
        bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not text or b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
            out.append(([], [], [], []))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        cuts = sorted(set(ends_a) & set(ends_b))
        groups = [
            ([i for i, e in zip(ids_a, ends_a) if lo < e <= hi], [i for i, e in zip(ids_b, ends_b) if lo < e <= hi])
            for lo, hi in zip([0, *cuts], cuts)
        ]
        ending = dict(zip(ends_b, ids_b))
        links = [(x, ending[p]) for x, p in zip(ids_a, ends_a) if p in ending]
        out.append((ids_a, ids_b, groups, links))
    return out


def expected_rows(keys, texts):
    hand = aligned_by_hand(texts)
    counts = Counter(pair for *_, links in hand for pair in links)
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    rows = []
    for key, (a, b, groups, links) in zip(keys, hand):
        joined = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        rows.append((
            key, len(a), len(b), len(groups), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links),
            hashlib.sha256(joined.encode()).hexdigest() if groups else "",
        ))
    return rows


def test_coalescing_equals_cutting_at_common_ends():
    draw = random.Random(3)
    for _ in range(200):
        n = draw.randrange(1, 60)
        cuts = [sorted({*draw.sample(range(1, n + 1), draw.randrange(0, n)), n}) for _ in range(2)]
        spans = [list(zip([0, *c], c)) for c in cuts]
        start, end = (np.array([s[k] for side in spans for s in side]) for k in (0, 1))
        group = alignment.coalesce(start, end, np.repeat([0, 1], [len(spans[0]), len(spans[1])]))
        common = sorted(set(cuts[0]) & set(cuts[1]))
        assert group.tolist() == [int(np.searchsorted(common, e)) for e in end]
        sides = [np.array(s) for s in spans]
        pairs = list(zip(*(x.tolist() for x in alignment.overlaps(sides[0][:, 0], sides[0][:, 1], sides[1][:, 0], sides[1][:, 1]))))
        assert pairs == [(i, j) for i, x in enumerate(spans[0]) for j, y in enumerate(spans[1]) if x[0] < y[1] and y[0] < x[1]]


def test_places_of_pairs_are_their_own():
    it = alignment.loaded(BYTES, PIECES)
    b_of = it.b_of_places()
    assert it.n_places < 700_000
    by_a, seen = defaultdict(list), {}
    for i, t in enumerate(it.bytes_a):
        by_a[t].append(i)
    draw = random.Random(5)
    ids = {t: i for i, t in enumerate(it.bytes_b) if t and not it.single[i]}
    for a in draw.sample(range(len(it.bytes_a)), 4000):
        for n in range(1, len(it.bytes_a[a]) + 1):
            for b in [ids.get(it.bytes_a[a][-n:])] + ([int(np.flatnonzero(it.single)[it.bytes_a[a][-1]])] if n == 1 else []):
                if b is not None:
                    place = int(it.places(np.array([a]), np.array([b]))[0])
                    assert b_of[place] == b and seen.setdefault(place, (a, b)) == (a, b)
    for t, b in draw.sample(sorted(ids.items()), 3000):
        for n in range(1, len(t)):
            for a in by_a.get(t[-n:], []):
                place = int(it.places(np.array([a]), np.array([b]))[0])
                assert b_of[place] == b and seen.setdefault(place, (a, b)) == (a, b)


@pytest.mark.parametrize("at_once", [10, 2_000_000])
def test_alignment_equals_brute_force(spark, frame, monkeypatch, at_once):
    monkeypatch.setattr(alignment, "AT_ONCE", at_once)
    texts = TEXTS + TEXTS[:1] + ["the fox and the box", "the the the"]
    docs = docs_of(frame, texts).withColumn("doc_id", F.when(F.col("doc_id") != 7, F.col("doc_id")))
    got = alignment.with_link_scores(alignment.aligned_documents(docs, BYTES, PIECES), BYTES, PIECES)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    keys = [None if n == 7 else n for n in range(len(texts))]
    assert Counter(tuple(r) for r in got.select(*names).collect()) == Counter(expected_rows(keys, texts))


def test_spans_cover_the_text(frame):
    docs = docs_of(frame, TEXTS[:1] + ["Straße 漢"] + TEXTS[1:3])
    rows = alignment.aligned_spans(docs, BYTES, PIECES).orderBy("doc_id", "group").collect()
    hand = aligned_by_hand([r["text"] for r in docs.orderBy("doc_id").collect()])
    assert {r["doc_id"] for r in rows} == {0, 1}
    for key in (0, 1):
        mine = [r for r in rows if r["doc_id"] == key]
        assert [(r["a"], r["b"]) for r in mine] == hand[key][2]
        assert mine[0]["start"] == 0 and all(x["end"] == y["start"] for x, y in zip(mine, mine[1:]))
        for r in mine:
            assert [(p["a"], p["b"]) for p in r["pairs"] if p["ends"]] == [(len(r["a"]) - 1, len(r["b"]) - 1)]
            assert len(r["pairs"]) == len(r["a"]) + len(r["b"]) - 1


def test_alignment_of_an_empty_table(frame):
    done = alignment.with_link_scores(alignment.aligned_documents(frame([], DOCS), BYTES, PIECES), BYTES, PIECES)
    assert done.count() == 0


def test_alignment_query(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    got = alignment.op11_interval_alignment(spark, FOLDER).collect()
    assert sorted(map(tuple, got)) == sorted(expected_rows([d["doc_id"] for d in docs], [d["text"] for d in docs]))


# --- conversation trie ----------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, depth long, n_convs long"


def trie_by_hand(rows):
    """All node rows of (conv_id, turn, role, text) rows, from the definition."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[conv].append(((turn is not None, turn or 0, tie), (role, text)))
    own = {c: [t for _, t in sorted(turns)] for c, turns in own.items()}
    nodes = defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        full = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
        for d in range(len(full) + 1):
            nodes[full[:d]].append((c, len(full) == d))
    out = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        words = lambda p: len([w for w in p[-1][1].translate({c: " " for c in (9, 10, 11, 12, 13)}).split(" ") if w]) if p else 0
        kids = lambda p: [q for q in below if len(q) == len(p) + 1 and q[: len(p)] == p]
        ends = ",".join(str(c) for c, end in sorted(members) if end)
        out.append((
            min(members)[0], len(path), min(nodes[path[:-1]])[0] if path else None, len(members), len(kids(path)),
            sum(not kids(p) for p in below), sum((len(nodes[p]) - 1) * words(p) for p in below), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return Counter(out)


def random_turns(seed, convs, texts, longest, spread=1):
    draw, rows = random.Random(seed), []
    for c in draw.sample(range(convs * spread), convs):
        for n in range(draw.randrange(1, longest)):
            rows.append((c, None if draw.random() < 0.05 else n, draw.choice(["user", "assistant", None]), draw.choice(texts)))
    return rows


@pytest.mark.parametrize("block", [1, 2, 7, 50_000])
@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_brute_force(frame, block, seed):
    rows = random_turns(seed, 120, ["a b", "a", "", None, " x\ty z ", "q"], 7, 1 + 3 * (seed == 2))
    rows += rows[:5] + [(None, 1, "user", "nobody"), (5, 1, "user", "same"), (5, 1, "user", "same")]
    rows += [(1000 + n, d, "user", f"long {d}") for n in range(3) for d in range(60)] + [(2000, None, None, None)]
    got = prefixes.trie(frame([(*r, 1, 2) for r in rows], TURNS), block)
    assert Counter(map(tuple, got.collect())) == trie_by_hand(rows)


def test_hot_conversation(frame):
    rows = [(c, t, "user", f"turn {t}") for c in range(300) for t in range(4)] + [(c, 0, "user", f"own {c}") for c in range(300, 330)]
    got = prefixes.trie(frame([(*r, 1, 2) for r in rows], TURNS), 50)
    assert Counter(map(tuple, got.collect())) == trie_by_hand(rows)


def test_runs_of_members_are_hashed_in_order(frame, monkeypatch):
    monkeypatch.setattr(prefixes, "RUN", 10)
    rows = [(c, 0, "user", "hello") for c in random.Random(1).sample(range(1000), 200)]
    got = prefixes.trie(frame([(*r, 1, 2) for r in rows], TURNS))
    assert Counter(map(tuple, got.collect())) == trie_by_hand(rows)


def test_trie_of_an_empty_table(frame):
    assert prefixes.trie(frame([], TURNS)).count() == 0


def test_radix_tree_layouts():
    draw = random.Random(4)
    keys = {bytes([b]) + bytes(draw.randrange(256) for _ in range(n)) for b in range(256) for n in (0, 1, 3)} | {b""}
    tree, order = prefixes.RadixTree(), list(keys)
    draw.shuffle(order)
    for key in order:
        tree.insert(key, key)
    seen, sizes = [], set()
    for _, after, node in tree.walk():
        sizes.add(node.size)
        if after >= 0 and node.value is not None:
            assert after == len(node.value)
            seen.append(node.value)
    assert seen == sorted(keys) and 256 in sizes
    for n in (3, 10, 30, 200):
        node = prefixes.Node(b"")
        for b in draw.sample(range(256), n):
            node.put(b, prefixes.Node(bytes([b])))
        assert node.size == min(s for s in (4, 16, 48, 256) if s >= n)
        assert [c.path[0] for c in node.below()] == sorted(c.path[0] for c in node.below()) and len(node.below()) == n
        assert all((found := node.find(b)) is None or found.path == bytes([b]) for b in range(256))

"""Conversation repair, token files and resampling against brute force on small tables."""

import hashlib
import io
import math
import random
import re
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

import public_tokenizers
from arrears.llm import conversations, resample, token_files
from llm_fixtures import nothing, odd, odd_rows, prose

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


# --- conversations

SPACE = " \t\n\x0b\x0c\r"
LEGAL = re.compile(r"(s?(ua)+)?")
#: row: initial, fault ('' none, 'x' must go, 't' truncated)
ROWS = st.lists(st.tuples(st.sampled_from("suat"), st.sampled_from(["", "", "x", "t"])), max_size=3)


def every_script(rows):
    """All scripts with at most two insertions at a place, by trying them."""
    best = None
    choices = [["D"] if fault == "x" else ["D", "K", "Ru", "Ra"] for _, fault in rows]
    inserts = ["", "u", "a", "ua", "au"]
    for edits in product(*choices):
        for gaps in product(inserts, repeat=len(rows) + 1):
            roles, labels, cost = gaps[0], "I" * len(gaps[0]), 2 * len(gaps[0])
            for (initial, fault), edit, gap in zip(rows, edits, gaps[1:]):
                roles += (initial if edit == "K" else edit[1:]) + gap
                labels += edit[0] + "I" * len(gap)
                cost += {"D": 3, "K": 0, "R": 2}[edit[0]] + 2 * len(gap) + (fault == "t" and edit != "D")
            if LEGAL.fullmatch(roles) and (best is None or (cost, labels) < best):
                best = (cost, labels)
    return best


@given(ROWS)
@settings(max_examples=60, deadline=None)
def test_the_auction_finds_the_least_cheapest_script(rows):
    codes = bytes(conversations.code_of(i, f == "x", f == "t") for i, f in rows)
    assert conversations.cheapest(codes) == every_script(rows)


@given(st.lists(st.integers(0, 15), max_size=60))
@settings(max_examples=60, deadline=None)
def test_prices_are_distances(codes):
    """Prices against relaxation until nothing changes."""
    codes = bytes(codes)
    end = 4 * (len(codes) + 1)
    cost = [10**9] * end + [0]
    while True:
        better = [min(min(c + cost[to] for _, c, to in conversations.arcs(codes, k)), cost[k]) for k in range(end)] + [0]
        if better == cost:
            break
        cost = better
    assert list(conversations.prices(codes)) == cost


def slow_repair(rows):
    """Rows (conv_id, turn, role, text) of a table before damage; the contract step by step."""
    said = lambda x: " " if x is None else str(x)
    out = {}
    for conv in {r[0] for r in rows}:
        own = []
        for _, turn, role, text in sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, said(r[2]), said(r[3]))):
            kind = zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20
            role, text = said(role), said(text)
            if kind == 0:
                continue
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = {t for t, _, _ in own if t is not None}
        faults, seen = [], set()
        for _, role, text in own:
            bare = text.rstrip(SPACE)
            faults.append("blank" if not bare else "dup" if (role, text) in seen else "" if bare[-1] in ".!?" else "cut")
            seen.add((role, text))
        initials = [r[:1] for _, r, _ in own]
        cost, audit = conversations.cheapest(bytes(conversations.code_of(i, f in ("blank", "dup"), f == "cut") for i, f in zip(initials, faults)))
        left, roles, k = [], "", 0
        asked = lambda: "assistant" if roles.endswith("u") else "user"
        for label in audit:
            if label == "I":
                left.append(f"{asked()}:")
                roles += asked()[0]
                continue
            _, role, text = own[k]
            k += 1
            if label != "D":
                role = asked() if label == "R" else role
                left.append(f"{role}:{text}")
                roles += role[0]
        assert k == len(own) and LEGAL.fullmatch(roles)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            faults.count("blank"), faults.count("dup"), faults.count("cut"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost, audit, hashlib.sha256("\n".join(left).encode()).hexdigest(),
        )
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_repaired_conversations_equal_the_slow_ones(spark):
    rng = random.Random(5)
    texts = ["One.", "Two?", "no end", "", " \t", None, "é!  \n", "One.", "a\nb."]
    rows = []
    for conv in [*range(60), None]:
        role = ["system", "user", "assistant", None, "tool", "USER", ""]
        for k in range(rng.randrange(1, 12)):
            rows.append((conv, rng.choice([None, k, k, k, k + 3]), rng.choice(role + role[1:3] * 3), rng.choice(texts)))
    rows += [(1000, k, "user" if k % 2 else "assistant", f"turn {k % 90}.") for k in range(700)]
    rows += rows[:9]
    df = spark.createDataFrame([(*r, 5, "x") for r in rows], "conv_id long, turn long, role string, text string, copies int, audit string")
    found = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in conversations.repaired(conversations.damaged(df)).collect()}
    want = slow_repair(rows)
    assert found.keys() == want.keys()
    assert {k: found[k] for k in want if found[k] != want[k]} == {}
    assert sum(w[5] > 0 for w in want.values()) > 20
    assert conversations.repaired(conversations.damaged(df.limit(0))).count() == 0


def test_a_conversation_without_rows_is_kept(spark):
    lost = next((c, t) for c in range(40) for t in range(40) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    df = spark.createDataFrame([(*lost, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    (row,) = conversations.repaired(conversations.damaged(df)).collect()
    assert tuple(row) == (lost[0], 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())


def test_conversations_of_the_tables(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    found = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in conversations.repaired(conversations.damaged(df)).collect()}
    assert found == slow_repair([(r.conv_id, r.turn, r.role, r.text) for r in df.collect()])


# --- token files


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(TOKENIZER)


@given(st.lists(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=40), max_size=12), st.floats(0, 1), st.integers(1, 9))
@settings(max_examples=120, deadline=None)
def test_files_keep_every_id(documents, share, block):
    held, chunk = token_files.BLOCK, token_files.CHUNK
    token_files.BLOCK, token_files.CHUNK = block, 2
    try:
        out = io.BytesIO()
        names = [None if k % 5 == 4 else k - 3 for k in range(len(documents))]
        data = [np.array(d, dtype="<u4").tobytes() for d in documents]
        n, total = token_files.write_file(out, zip(names, data), share)
        assert (n, total) == (len(documents), sum(map(len, documents)))
        file = token_files.TokenFile(out, out.tell())
        assert [file.document(k).tolist() for k in range(n)] == documents
        assert file.checksums().tolist() == [zlib.crc32(d) for d in data]
        assert [int(i) if k else None for i, k in zip(file.doc_ids, file.known)] == names
        assert sum(len(ids) for _, ids in file.chunks()) == file.n_ids == total
    finally:
        token_files.BLOCK, token_files.CHUNK = held, chunk


def test_blocks_are_narrow_with_few_exceptions():
    rng = np.random.default_rng(2)
    ids = rng.integers(1000, 1200, (4, 1024)).astype(np.uint32)
    ids[:, ::64] = 40_000
    blocks = token_files.encode_blocks(ids)
    assert all(b[2] == 8 for b in blocks) and max(map(len, blocks)) == 10 + 1024 + 16 * 6
    assert np.array_equal(np.stack(token_files.decode_blocks([memoryview(b) for b in blocks])), ids)


@given(st.lists(st.text(max_size=40), max_size=5))
@settings(max_examples=100, deadline=None)
def test_encoder_equals_the_library(library, texts):
    if not hasattr(test_encoder_equals_the_library, "own"):
        test_encoder_equals_the_library.own = token_files.LibraryEncoder(open(TOKENIZER, encoding="utf-8").read())
    own = test_encoder_equals_the_library.own
    assert own.plain
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    for plain in (True, False):
        own.plain = plain
        ids, starts = own.encode(pa.array([*texts, None, ""], pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])] == [*want, [], []]
    own.plain = True


def test_token_files_of_odd_rows(spark, library, tmp_path):
    df = odd(spark).unionByName(odd(spark).filter("doc_id = 3"))
    folder = f"file://{tmp_path}/tokens"
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    files = token_files.write_tokens(df, TOKENIZER, folder)
    spark.conf.unset(coalesce)
    found = token_files.read_checksums(files, folder).collect()
    rows = [*odd_rows(), *[r for r in odd_rows() if r[0] == 3]]
    ids = [(i, [*library.encode(t or "", add_special_tokens=False).ids, 1]) for i, t, *_ in rows]
    key = lambda i, n, c: (i is not None, i or 0, n, c)
    want = sorted(key(i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in ids)
    assert sorted(key(r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == want
    ordered = sorted(found, key=lambda r: r.start)
    assert [r.start for r in ordered] == [0, *np.cumsum([r.n_tokens for r in ordered])[:-1].tolist()]
    assert [(r.doc_id is not None, r.doc_id or 0) for r in ordered] == sorted((r.doc_id is not None, r.doc_id or 0) for r in ordered)
    assert files.count() > 1 and files.agg({"ids": "sum"}).first()[0] == sum(len(x) for _, x in ids)
    assert token_files.token_positions(nothing(spark), TOKENIZER).count() == 0


# --- resampling


def slow_words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def slow_hashes(text):
    words = slow_words(text)
    return [zlib.crc32(" ".join(words[k : k + n]).encode()) for n in (1, 2, 3) for k in range(len(words) - n + 1)]


@given(st.lists(st.one_of(st.text(max_size=30), st.lists(st.sampled_from(["a", "B9", "é", "-", "日本", "x" * 70, "word" * 300]), max_size=8).map(" ".join)), max_size=5))
@settings(max_examples=150, deadline=None)
def test_prefix_hashes_equal_those_of_the_runs(texts):
    hashes, whose, count = resample.feature_hashes(texts, resample.Shifts())
    assert count.tolist() == [len(slow_words(t)) for t in texts]
    for k, t in enumerate(texts):
        assert Counter(hashes[whose == k].tolist()) == Counter(slow_hashes(t))


def slow_resample(rows, target):
    source, wanted = Counter(), Counter()
    for _, t in rows:
        source.update(h % 10000 for h in slow_hashes(t))
    for t in target:
        wanted.update(h % 10000 for h in slow_hashes(t))
    s_all, t_all = sum(source.values()), sum(wanted.values())
    gain = [math.floor(1000 * math.log((wanted[b] + 1) * (s_all + 10000) / ((source[b] + 1) * (t_all + 10000)))) for b in range(10000)]
    out, able = [], []
    for i, t in rows:
        hashes = slow_hashes(t)
        weight = sum(gain[h % 10000] for h in hashes)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(hashes), weight, score, None])
        if len(slow_words(t)) >= 20:
            able.append(out[-1])
    able.sort(key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    for k, r in enumerate(able[: 5 * len(able) // 100]):
        r[4] = k + 1
    return sorted(map(str, out))


def test_resampled_rows_equal_the_slow_ones(spark):
    rows = [(i, t) for i, t, *_ in odd_rows()] + [(100 + k, prose(k, 5 + k % 60)) for k in range(300)] + [(77, prose(1, 40))] * 60
    target = [prose(k, 30) for k in range(5)] + [None, ""]
    docs = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "doc_id long, text string, score int, rank int, bucket string").repartition(4)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    found = resample.resampled(docs, wanted)
    assert sorted(str([r[c] for c in columns]) for r in found.collect()) == slow_resample(rows, target)
    assert resample.resampled(docs.limit(0), wanted).count() == 0
    assert resample.resampled(docs, wanted.limit(0)).filter("rank is not null").count() > 0


def test_resampled_documents_of_the_tables(spark):
    docs, target = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    found = resample.resampled(docs, target).select("doc_id", "n_features", "weight", "score", "rank")
    want = slow_resample([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()])
    assert sorted(str(list(r)) for r in found.collect()) == want


def test_ranks_when_the_quantile_is_short(spark, monkeypatch):
    monkeypatch.setattr(resample, "SORTED_SHARE", -0.04)
    df = spark.range(1000).selectExpr("id as doc_id", "30L as n_words", "1L as n_features", "0L as weight", "id % 7 as score")
    ranks = sorted((r.rank, r.doc_id) for r in resample.ranked(df).filter("rank is not null").collect())
    assert ranks == [(k + 1, 6 + 7 * k) for k in range(50)]

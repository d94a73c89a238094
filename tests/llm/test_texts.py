"""BPE, line rules, surrogates, classifiers, mixing, sharding and the pipeline on small tables."""

import hashlib
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

import corpus_pipeline
import public_tokenizers
from arrears.llm import bpe, line_rules, mixing, pii, quality, sharding, simhash, toxicity
from arrears.llm.common import numbered
from llm_fixtures import SCHEMA, nothing, odd, odd_rows, prose

SF = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


# --- BPE


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(TOKENIZER)


@pytest.fixture(scope="module")
def own():
    with open(TOKENIZER, encoding="utf-8") as f:
        return bpe.TrieTokenizer(f.read())


def library_ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


@given(st.lists(st.text(max_size=40), max_size=6))
@settings(max_examples=150, deadline=None)
def test_any_text_is_encoded_and_decoded_as_the_library_does(library, own, texts):
    for text, got in zip(texts, own.encode_batch(texts)):
        ids = library_ids(library, text)
        assert np.frombuffer(got, "<u4").tolist() == ids
        assert own.decode(got) == library.decode(ids, skip_special_tokens=False)


@given(st.lists(st.sampled_from("the ing er at an 's 'll T h e i n g é 7 - . ### aaa ion".split() + [" "]), max_size=40))
@settings(max_examples=150, deadline=None)
def test_glued_words(library, own, parts):
    text = "".join(parts)
    assert np.frombuffer(own.encode_batch([text])[0], "<u4").tolist() == library_ids(library, text)


def test_tokenized_rows(spark, library):
    found = bpe.tokenized(odd(spark), TOKENIZER, ids=True).collect()
    want = []
    for i, t, *_ in odd_rows():
        ids = library_ids(library, t)
        text = library.decode(ids, skip_special_tokens=False)
        want.append((str(i), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found) == sorted(want)
    assert all(len(r.ids) == r.n_tokens for r in found)
    assert bpe.tokenized(nothing(spark), TOKENIZER).count() == 0


# --- line rules


def test_line_rules_equal_their_twin(spark):
    rows = odd_rows() + [(100 + k, f"{prose(400 + k, 60)}\nShared Line of the host here\n{prose(500 + k, 20)}", "en", "host", 1, 7, 8, "x", 2) for k in range(30)]
    rows += [(200 + k, f"{prose(600 + k, 55)}\n" + "\n".join(["Shared  line of the HOST here\t"] * 12), "en", "host", 1, 7, 8, "x", 2) for k in range(3)]
    rows += [(300 + k, f"{prose(700, 55)}\nanother line of many copies\n{prose(701, 20)}", "en", "host", 1, 7, 8, "x", 2) for k in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    con = duckdb.connect()
    con.register("documents", df.toArrow())
    want = con.execute(line_rules.ORACLE)
    columns = [d[0] for d in want.description]
    found = line_rules.judged(df).select(*columns).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want.fetchall()))
    by_id = {r.doc_id: r for r in found}
    assert by_id[100].n_removed_words == 6 and by_id[100].kept
    assert by_id[200].n_removed_words == 72 and not by_id[200].kept
    assert by_id[300].n_removed_words == 0 and by_id[300].kept
    assert line_rules.judged(nothing(spark)).count() == 0


def test_documents_that_share_two_lines_count_each(spark):
    """A header and a footer of thirty distinct documents: whichever digest is the least, both go."""
    shared = ["header of this host and its pages", "footer of this host and its pages"]
    rows = [(k, f"{shared[0]}\n{prose(800 + k, 60)}\n{shared[1]}", "host") for k in range(30)]
    rows += [(100 + k, "\n".join(shared * 5), "other") for k in range(30)]  # copies count once
    found = line_rules.judged(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert {r.n_removed_words for r in found if r.doc_id < 100} == {14}
    assert {r.n_removed_words for r in found if r.doc_id >= 100} == {0}


def test_copies_of_one_document_do_not_hide_a_banner(spark):
    rows = [(k, f"banner of the host\n{prose(900 + k, 8)}\nits second line too", "host") for k in range(40)]
    rows += [(1000 + k, prose(3, 60), "host") for k in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = line_rules.judged(df).collect()
    assert {r.n_removed_words for r in found if r.doc_id < 1000} == {8}
    assert {r.kept for r in found if r.doc_id < 1000} == {False} and {r.kept for r in found if r.doc_id >= 1000} == {True}
    con = duckdb.connect()
    con.register("documents", df.toArrow())
    want = con.execute(line_rules.ORACLE)
    columns = [d[0] for d in want.description]
    assert sorted(str(tuple(r[c] for c in columns)) for r in found) == sorted(map(str, want.fetchall()))
    assert {r.n_removed_words for r in line_rules.judged(df, max_share=0.99).collect()} == {0}


def test_line_rules_run_no_python(spark):
    plan = line_rules.statistics(odd(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- surrogates

MAIL, CARD, IP = "ann.smith@mail7.example.com", "4929 3483 8514 6306", "97.51.17.173"
PERSONAL = f"Mrs. Anna Kowalski and Mr Smith wrote from {MAIL} or +1 (017) 555-7713, card {CARD}, ip {IP}, ssn 123-45-6789, token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\"."


def test_surrogates_keep_types_and_formats():
    new, counts = pii.replaced(PERSONAL, b"key")
    assert counts == {"name": 2, "email": 1, "phone": 1, "card": 1, "ip": 1, "ssn": 1, "secret": 1}
    shape = lambda t: re.sub("[a-z]", "a", re.sub(r"\d", "0", t))
    cut = lambda t: shape(t.split("ip ")[0].split("wrote")[1])
    assert cut(new) == cut(PERSONAL) and "+1 (" in new and ".com" in new
    assert new.split()[1] in pii.GIVEN_NAMES["f", "latin"]
    for secret in (MAIL, CARD, IP, "Kowalski", "Smith", "7713", "123-45-6789", "04dbebab"):
        assert secret not in new
    octets = [int(x) for x in re.search(r"ip ([\d.]+),", new)[1].split(".")]
    assert max(octets) < 256
    assert pii.replaced(PERSONAL, b"key")[0] == new != pii.replaced(PERSONAL, b"other")[0]
    assert pii._luhn("411111111111111") == 1
    body = re.sub(r"\D", "", pii.surrogate(b"k", "card", "4111-1111-1111-1111"))
    assert pii._luhn(body[:-1]) == int(body[-1])
    assert "CYRILLIC" in __import__("unicodedata").name(pii.surrogate(b"k", "name_m", "Иван Петров")[0])


@pytest.mark.parametrize("number", ["+1 555 123 4567", "555 123 4567", "+34 612 345 678", "+15551234567", "+49 30 1234567", "+33 1 23 45 67 89"])
def test_phones_with_spaces_and_country_codes(number):
    new, counts = pii.replaced(f"call {number}, please", b"key")
    assert counts == {"phone": 1} and number not in new
    assert re.sub(r"\d", "0", new) == re.sub(r"\d", "0", f"call {number}, please")


@pytest.mark.parametrize("before, value", [('{"api_key": "', "abcdEFGH1234567"), ("token: ", "eyJhbGciOi.eyJzdWIiOi.sflKxwRJ-x"), ("Authorization: Bearer ", "ab3.def123.ghi4567890"), ("password=", "hunter2")])
def test_secrets_in_quoted_keys_with_dots_and_short(before, value):
    assert [x[2:] for x in pii.found(before + value)] == [("secret", value)]


def test_later_mentions_of_a_titled_name():
    text = "Mr John Smith came. John Smith said so, and Smith left. Mrs Smith and Dr John Smith stayed, Smithson too."
    new, counts = pii.replaced(text, b"key")
    assert counts == {"name": 5} and not re.search(r"\b(John|Smith)\b", new) and "Smithson" in new
    full = pii.surrogate(b"key", "name_m", "John Smith")
    assert new.count(full) == 3 and len(re.findall(rf"\b{full.split()[1]}\b", new)) == 5


@given(st.integers(2, 3000), st.text(max_size=3))
@settings(max_examples=40, deadline=None)
def test_ciphers_are_permutations(limit, tweak):
    some = range(0, limit, max(1, limit // 50))
    assert len({pii.permuted(b"k", v, limit, tweak) for v in some}) == len(some)
    assert all(0 <= pii.permuted(b"k", v, limit, tweak) < limit for v in some)


def test_documents_lose_their_personal_data(spark):
    rows = odd_rows() + [(500, PERSONAL, "en", "s", 1, 7, 8, "x", 2), (501, f"again {MAIL}.", "en", "s", 1, 7, 8, "x", 2)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = pii.surrogates(df, "key")
    assert found.columns == [*df.columns, "__counts"]
    out = found.collect()
    assert len(out) == len(rows)
    left = {r.doc_id: r for r in out}
    mail = pii.surrogate(b"key", "email", MAIL)
    assert mail in left[500].text and mail in left[501].text and left[500].n_chars == len(left[500].text)
    assert left[4].text is None and left[5].text == "" and left[9].text == odd_rows()[9][1]
    assert pii.surrogates(nothing(spark), "key").count() == 0


def test_colliding_names_are_drawn_again(spark, monkeypatch):
    rows = [(i, f"Mr. {n} came.") for i, n in enumerate(f"{a}{b}" for a in ("Ka", "Lu", "Mo", "Ri", "Te", "Za") for b in "bdfgklmnprstvz")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    names = [t.split()[1] for _, t in rows]
    first = Counter(pii.surrogate(b"key", "name_m", n) for n in names)
    assert max(first.values()) > 1
    want = None
    for limit in (pii.BROADCAST_EXCEPTIONS, 0):
        monkeypatch.setattr(pii, "BROADCAST_EXCEPTIONS", limit)
        got = {r.doc_id: r.text for r in pii.surrogates(docs, "key").collect()}
        assert len(set(got.values())) == len(rows) and want in (None, got)
        assert not {t.split()[1] for t in got.values()} & set(names)
        want = got


def test_many_distinct_names_settle(spark):
    """More names than the first draws have room for: all get surrogates of their own."""
    parts = [f"{a}{b}{c}{d}" for a in ("Ka", "Lu", "Mo", "Ri") for b in "bdfglmnrst" for c in "aeiou" for d in ("d", "lan", "ner", "vik")]
    names = [f"{g} {n}" for g in ("Olaf", "Bertram", "Ivo", "Quentin", "Ulf") for n in parts]
    found = spark.createDataFrame([("name_m", n) for n in names], "kind string, entity string")
    tries = {r.entity: r.attempt for r in pii.collisions(found, "key").collect()}
    new = {pii.surrogate(b"key", "name_m", n, tries.get(n, 0)) for n in names}
    assert len(new) == len(names) == 4000 and not new & set(names)


# --- classifiers


def test_counterfactual_pairs_take_the_weight_off_groups():
    insults, groups = ["idiot", "moron"], ["muslim", "women", "gay"]
    toxic = [f"the {g} is a {w} {prose(k, 6)}" for k in range(20) for g in groups for w in insults]
    neutral = [f"the weather {prose(900 + k, 8)}" for k in range(120)]
    labels = [1] * len(toxic) + [0] * len(neutral)
    plain = toxicity.train_on_texts(toxic + neutral, labels, 1 << 12, agree=0.0)
    fair = toxicity.train_on_texts(toxic + neutral, labels, 1 << 12, agree=5.0)
    mention = [f"the {g} went home" for g in groups]
    assert max(map(fair.scorer(), mention)) < min(map(plain.scorer(), mention))
    assert min(map(fair.scorer(), toxic)) > 0.5 > max(map(fair.scorer(), neutral))
    swaps = [(f"a {a} idiot", f"a {b} idiot") for a, b in (("muslim", "christian"), ("women", "men"), ("gay", "straight"))]
    assert max(abs(fair.scorer()(a) - fair.scorer()(b)) for a, b in swaps) < 0.02


def test_toxicity_of_the_tables(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    found = {r.doc_id: r for r in toxicity.scored(docs, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in found.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found.values())
    known = {r.doc_id: r.toxic for r in labels.collect()}
    test = [(found[i].predicted, y) for i, y in known.items() if found[i].held_out]
    hits = sum(p == y == 1 for p, y in test)
    assert hits >= 0.6 * sum(y for _, y in test) and hits >= 0.8 * sum(p for p, _ in test)


def test_toxicity_of_odd_rows(spark):
    labels = spark.createDataFrame([(1, None, None), (2, 1, 1), (2, 1, 1), (None, 1, 1), (5, 0, 0), (7, 0, 3)], "doc_id long, quality int, toxic int")
    found = toxicity.scored(odd(spark), labels).collect()
    assert len(found) == len(odd_rows()) and all(0 <= r.score <= 1 for r in found)
    none = toxicity.scored(odd(spark), labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5} and {r.predicted for r in none} == {1}
    assert toxicity.scored(nothing(spark), labels).count() == 0


def test_quality_without_true_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    found = {r.doc_id: r for r in quality.scored(docs).collect()}
    known = {r.doc_id: r.quality for r in labels.collect()}
    bad = [found[i].kept for i, y in known.items() if y == 0]
    good = [found[i].kept for i, y in known.items() if y == 1]
    assert sum(bad) <= 0.1 * len(bad) and sum(good) >= 0.98 * len(good)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {i for i, r in found.items() if r.kept}


def test_quality_of_odd_rows(spark):
    found = quality.scored(odd(spark)).collect()
    assert Counter(r.doc_id for r in found) == Counter(r[0] for r in odd_rows())
    assert all(0 <= r.score <= 1 for r in found)
    assert quality.scored(nothing(spark)).count() == 0 and quality.keep_good(nothing(spark)).count() == 0


def test_expectation_maximisation_finds_reliable_labellers():
    rng = np.random.default_rng(3)
    truth = rng.random(20000) < 0.8
    accuracy = [0.95, 0.9, 0.9, 0.85, 0.8, 0.9, 0.7, 0.9, 0.95]
    votes = np.stack([np.where(rng.random(20000) < 0.3, 2, np.where(rng.random(20000) < a, truth, ~truth)) for a in accuracy], axis=1)
    codes = votes @ (3 ** np.arange(len(accuracy) - 1, -1, -1))
    table, prior, posterior = quality.reliabilities(Counter(codes.tolist()))
    guess = np.array([posterior[c] for c in codes]) > 0.5
    assert (guess == truth).mean() > 0.97 and abs(prior - 0.8) < 0.03
    assert np.abs(table[:, 1, 1] - accuracy).max() < 0.03


# --- mixing


@given(st.lists(st.integers(0, 500), min_size=1, max_size=80), st.floats(0.01, 0.99))
@settings(max_examples=60, deadline=None)
def test_the_flight_keeps_words_and_count(sizes, rate):
    x, p = np.array(sizes, dtype=float), np.full(len(sizes), rate)
    after = mixing.flight(p, x)
    assert ((after > 1e-9) & (after < 1 - 1e-9)).sum() <= 2
    assert abs(after.sum() - p.sum()) < 1e-6 and abs((after * x).sum() - (p * x).sum()) < 1e-3
    landed = mixing.landing(p, x)
    assert set(landed) <= {0.0, 1.0} and abs((landed * x).sum() - (p * x).sum()) <= x.max() / 2 + 1e-6


def slow_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in stopped]
        level = (total - sum(stopped.values())) / max(1, sum(weight[s] for s in free))
        over = [s for s in free if weight[s] * level > 3 * sizes[s]]
        if not over:
            return {s: stopped.get(s, weight[s] * level) for s in names}
        stopped |= {s: 3 * sizes[s] for s in over}


def test_targets_of_sources(spark):
    rows = [("b", 40), ("a", 3), ("B", 700), (None, 9), ("é", 0), ("z", 5000), ("a", 0), ("𝄞", 30), ("ﬁ", 2)]
    found = {r.source: r for r in mixing.targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    sizes = Counter()
    for s, n in rows:
        sizes[s] += n
    want = slow_targets(dict(sizes))
    assert found.keys() == want.keys()
    assert all(abs(found[s].target - want[s]) < 1e-6 and found[s].source_size == sizes[s] for s in want)


def test_mix_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 8)
    rows = odd_rows() + [(700 + k, prose(k, 5 + k % 40), "en", "big", 1, 7, 8, "x", 2) for k in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    key = lambda r: (str(r.doc_id), r.size, str(r.source), r.copies)
    found = mixing.mixed(df.repartition(2), block=8).collect()
    assert sorted(map(key, found)) == sorted(map(key, mixing.mixed(df.repartition(5), block=8).collect()))
    assert sorted((str(r.doc_id), r.size) for r in found) == sorted((str(i), len((t or "").encode().split())) for i, t, *_ in rows)
    taken, sizes = Counter(), Counter()
    for r in found:
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r.size
        taken[r.source] += r.taken
        sizes[r.source] += r.size
    want = slow_targets(dict(sizes))
    assert abs(taken["big"] - want["big"]) < 45
    assert mixing.mixed(nothing(spark)).count() == 0 and mixing.repeated(nothing(spark)).count() == 0
    out = mixing.repeated(df)
    assert out.columns == df.columns
    copies = Counter(str(r.doc_id) for r in out.collect())
    default = Counter()
    for r in mixing.mixed(df).collect():
        default[str(r.doc_id)] += r.copies
    assert copies == +default


# --- sharding


def test_shards_of_odd_rows(spark, tmp_path):
    rows = odd_rows() + [(900 + k, prose(k, 20 + k % 50), "en", "s", 1, 7, 8, "x", 2) for k in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = sharding.sharded(df, 5, str(tmp_path / "map")).collect()
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in found) == sorted(
        (str(i), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in rows
    )
    sizes = Counter()
    places = {}
    for r in found:
        sizes[r.shard] += r.size
        places.setdefault(r.shard, []).append(r.slot)
    assert set(sizes) == set(range(5)) and max(sizes.values()) < 1.02 * min(sizes.values())
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert sharding.load_map(spark, str(tmp_path / "map"), 1).filter("shard != vslot % 5").count() == 0
    assert sharding.sharded(nothing(spark), 5, str(tmp_path / "none")).count() == 0


def test_equal_rows_are_numbered_in_chunks(spark):
    rows = [(1, "a")] * 1000 + [(None, "a")] * 7 + [(None, None)] * 300 + [(2, "b")]
    found = numbered(spark.createDataFrame(rows, "i int, t string").repartition(3), "n", chunk=64).collect()
    held = {}
    for r in found:
        held.setdefault((r.i, r.t), []).append(r.n)
    assert {k: sorted(v) for k, v in held.items()} == {k: list(range(n)) for k, n in Counter(rows).items()}
    assert numbered(spark.createDataFrame([], "i int"), "n").count() == 0


def test_a_row_that_a_third_of_the_table_repeats(spark, tmp_path):
    rows = [(5, prose(1, 30), "en", "s", 1, 7, 8, "x", 2)] * 2000
    rows += [(900 + k, prose(k, 20 + k % 50), "en", "s", 1, 7, 8, "x", 2) for k in range(4000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = sharding.sharded(df, 5, str(tmp_path / "map")).collect()
    sizes, slots = Counter(), Counter()
    for r in found:
        sizes[r.shard] += r.size
        slots[r.vslot] += 1
    assert len(found) == len(rows) and max(slots.values()) < 20
    assert max(sizes.values()) < 1.02 * min(sizes.values())
    mix = mixing.mixed(df, block=64).collect()
    assert len(mix) == len(rows) and sum(r.doc_id == 5 for r in mix) == 2000
    target = mix[0].target
    assert abs(sum(r.taken for r in mix) - target) < 0.001 * target + 70


def test_the_limit_of_sameness_has_no_steps():
    def limit(n):
        return next(x for x in np.linspace(0.7, 1, 30001) if quality.votes(n, {"sameness": x})[-1] == 0)

    limits = [limit(n) for n in (40, 400, 401, 999, 1000, 1001, 1600, 40000)]
    assert limits == sorted(limits) and limits[0] == pytest.approx(0.8, abs=1e-4) == limits[1]
    assert max(limits[2] - limits[1], limits[5] - limits[3]) < 1e-3 and limits[6] == pytest.approx(0.9, abs=1e-4)


def test_a_grown_map_moves_slots_into_the_new_shard_only():
    rng = np.random.default_rng(1)
    weights = {v: int(rng.lognormal(6, 1)) for v in range(512)}
    old = sharding.rebalanced(sharding.first_map(7, 512), weights, 7)
    new = sharding.grown(old, weights, 7)
    moved = {v for v in old if old[v] != new[v]}
    assert moved and all(new[v] == 7 for v in moved)
    total = Counter()
    for v, s in new.items():
        total[s] += weights[v]
    assert max(total.values()) < 1.15 * min(total.values())
    even = sharding.rebalanced(old, weights, 8)
    total = Counter()
    for v, s in even.items():
        total[s] += weights[v]
    assert max(total.values()) < 1.01 * min(total.values())


# --- pipeline


def test_pipeline_stages(spark, library):
    """Each stage against a plain version of it on what the stage before kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    made = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = corpus_pipeline.written(stage(spark, docs, SF), "test-stage")
        assert docs.columns == columns
        made.append(docs.collect())
        if name == "quality classifier":
            kept = {r.doc_id for r in quality.scored(before).filter("kept").collect()}
            assert {r.doc_id for r in made[-1]} == kept < {r.doc_id for r in made[0]}
        if name == "source mix":
            copies = {r.doc_id: r.copies for r in mixing.mixed(before).collect()}
    _, good, single, clean, mix = made
    fps = {r.doc_id: simhash.fingerprint(r.text) for r in good}
    groups = {i: {i} for i in fps}
    for i in sorted(fps):
        for j in fps:
            if i < j and (fps[i] ^ fps[j]).bit_count() <= 4 and groups[i] is not groups[j]:
                joined = groups[i] | groups[j]
                groups |= {k: joined for k in joined}
    assert {r.doc_id for r in single} == {min(g) for g in groups.values()} and len(single) < len(good)
    want = {r.doc_id: pii.replaced(r.text, pii.DEFAULT_KEY.encode())[0] for r in single}
    assert {r.doc_id: r.text for r in clean} == want and all(r.n_chars == len(r.text) for r in clean)
    assert sum(a.text != want[a.doc_id] for a in single) > 3
    assert Counter(r.doc_id for r in mix) == +Counter(copies)
    ids = Counter((r.doc_id, tuple(library_ids(library, r.text))) for r in mix)
    found = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in found) == ids
    again = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.ids_sha256) for r in again) == sorted((r.doc_id, r.ids_sha256) for r in found)

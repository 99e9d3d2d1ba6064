"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import itertools
import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm.brute import best_fit, near_components
from orderloom.llm import mixing
from orderloom.llm.chat import Template, chat_digests, format_chats, learned_texts, read_turns
from orderloom.llm.components import components
from orderloom.llm.exact_dedup import advance, exact_dedup, read_state, sha256, without_copies
from orderloom.llm.html_blocks import blocks_of
from orderloom.llm.html_text import Repeats, common_starts, extract_text
from orderloom.llm.mixing import Mix, Source, apportion, mix_documents, mixed_rows, shard_quotas, targets
from orderloom.llm.near_dup import BLOCK, Sketch, near_duplicates, without_near_copies
from orderloom.llm.neighbours import nearest_neighbours
from orderloom.llm.packing import best_fit_decreasing, pack
from orderloom.llm.separator_scan import scan_token_files, token_counts, write_token_files
from orderloom.llm.tables import Scratch, join_counted, running_total
from orderloom.llm.tokens import WordTokenizer
from orderloom.llm.toxicity import learn, score_documents, without_toxic, word_terms, words
from orderloom.llm.url_rules import judge_urls

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
LONG = " ".join(f"w{i % 5003}" for i in range(40_000))
ODD = [
    (1, None, None), (2, "", "a"), (2, "", "a"), (None, "one two", "a"), (3, "x y z v w", "b"), (4, LONG, "b"),
    (5, "x y z v w", None), (6, "X y\tz  v w", "é"), (-7, "<|endoftext|> 'll ΑΣ \x00 a\x85b", "é"),
]
CLASHING = ("kept", "digest", "node", "size", "file", "row", "copies", "_copy", "group_size", "_id", "keep_id", "score", "_toxicity")


@pytest.fixture
def odd(spark):
    rows = spark.createDataFrame(ODD, "doc_id long, text string, source string").repartition(3)
    return rows.select("*", *(F.lit(f"own {c}").alias(c) for c in CLASHING))


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([(4, 1), (4, None), (None, 1), (99, 0)], "doc_id long, toxic int")


def ids(rows):
    return Counter(r.doc_id for r in rows.collect())


EVERY = Counter(doc for doc, _, _ in ODD)


def test_odd_documents(odd, labels):
    found = {(r.doc_id, r.text_sha256): r for r in exact_dedup(odd).collect()}
    empty = next(r for (doc, _), r in found.items() if doc == 1)
    assert (empty.keep_id, empty.group_size, empty.kept) == (2, 3, False)
    assert sum(r.kept for r in exact_dedup(odd).collect()) == 6
    for rows in (
        exact_dedup(odd), score_documents(odd, learn(odd, labels)), token_counts(odd, PIECES),
        mix_documents(odd), near_duplicates(odd),
    ):
        assert ids(rows) == EVERY
    assert set(ids(pack(odd, WORDS))) == set(EVERY)
    near = {r.doc_id: r for r in near_duplicates(odd).collect()}
    assert near[1].n_shingles == 0 and near[1].component_id == 1 and near[None].component_id is None
    assert {near[d].component_id for d in (3, 5, 6)} == {3} and near[4].n_shingles > 4000


def test_stages_keep_all_columns(odd, labels):
    for rows in (without_toxic(odd, labels), without_copies(odd), without_near_copies(odd), mixing.mixed_rows(odd)):
        assert rows.columns == odd.columns
        assert all(r.kept == "own kept" for r in rows.collect())
    assert without_copies(odd).count() == 6


def test_empty_tables(spark, odd, labels):
    none = odd.limit(0)
    model = learn(none, labels.limit(0))
    for rows in (
        exact_dedup(none), score_documents(none, model), token_counts(none, PIECES), pack(none, WORDS),
        mix_documents(none), near_duplicates(none), without_copies(none), without_near_copies(none),
        judge_urls(spark.createDataFrame([], "page_id long, url string"), spark.createDataFrame([], "host string, path string, verdict string")),
        extract_text(spark.createDataFrame([], "page_id long, url string, html string")),
        chat_digests(format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))),
        nearest_neighbours(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") >= 0),
    ):
        assert rows.count() == 0


# ---- exact dedup


def test_texts_that_share_a_digest_are_told_apart(spark):
    rows = [(i, f"text {i % 7}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r.doc_id: r for r in exact_dedup(docs, digest=lambda t: F.substring(sha256(t), 1, 0)).collect()}
    assert {d: found[d].keep_id for d in found} == {i: max(j for j, t in rows if t == text) for i, text in rows}
    assert all(r.group_size == sum(t == rows[d][1] for _, t in rows) for d, r in found.items())


def test_state_lasts_over_batches(spark):
    scratch = Scratch(spark, "state-test")
    folder, checkpoint = scratch.path("digests"), scratch.path("state")
    schema = "digest string, doc_id long, file string, row long"
    for batch in ([("a", 1, "f", 0), ("b", 2, "f", 1)], [("a", 9, "g", 0), ("c", 3, "g", 1)]):
        spark.createDataFrame(batch, schema).write.mode("append").parquet(folder)
        advance(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder), checkpoint)
    state = {r.digest: (r.kept.doc_id, r.group_size) for r in read_state(spark, checkpoint).collect()}
    assert state == {"a": (9, 2), "b": (2, 1), "c": (3, 1)}


# ---- pages and urls


def test_blocks():
    page = """<html><body class="has-sidebar"><header><h1>Site</h1></header><nav><li>Home<li>About</nav>
    <div class="cookie-notice">We use cookies</div><article><header><h1>Head &amp; tail</h1><p>By me</p></header>
    <p>One <b>two</b>\n three<br>four&nbsp;five<p>a < b <a title='x>y'>link</a><aside>Side</aside>
    <form><label>Name</label></form><section id="comments"><p>nice</p></section></article><footer>&copy;</footer>
    <script>if(a<b){"</p>"}</script><!-- <p>no</p> --></body>"""
    assert [b.text for b in blocks_of(page) if b.place == 0] == ["Head & tail", "One two three four five", "a < b link"]
    assert blocks_of(None) == [] and [b.text for b in blocks_of("<p>a<script>x")] == ["a"]


@settings(max_examples=50, deadline=None)
@given(tokens=st.lists(st.integers(0, 2), max_size=40), depth=st.integers(1, 9))
def test_common_starts(tokens, depth):
    ranks = common_starts(np.array(tokens, np.int64), depth)
    for i in range(len(tokens)):
        for j in range(len(tokens)):
            if max(i, j) + depth <= len(tokens):
                assert (ranks[i] == ranks[j]) == (tokens[i : i + depth] == tokens[j : j + depth])


@pytest.mark.parametrize("shard", [1 << 19, 150])
def test_repeats_of_a_host_go_and_unique_text_stays(spark, shard):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(5000)]
    chrome = "<div>Home</div><div>About us</div><div>Contact our team</div><div>More things</div>"
    foot = "<div>All rights of this site belong to its owners since two thousand and one</div>"
    pages, expected = [(100, None, None, "x"), (101, "http://a.org/x", "", "x")], {100: "", 101: ""}
    for i in range(50):
        body = [" ".join(rng.choices(words, k=30)) for _ in range(3)]
        top, end = (chrome, foot) if i < 40 else ("", "")
        pages.append((i, f"http://{'a' if i < 40 else 'b'}.org/{i}", top + "".join(f"<p>{b}</p>" for b in body) + end, "x"))
        expected[i] = "\n".join(body)
    table = spark.createDataFrame(pages, "page_id long, url string, html string, host string")
    found = extract_text(table, Repeats(shard=shard)).collect()
    assert {r.page_id: r.text for r in found} == expected


def test_every_unique_run_stays_however_short(spark):
    """Unmarked pages: what repeats on three pages goes, everything else of a block stays."""
    notice = "this very long notice is the same on every page of the site"
    pages, expected = [], {}
    for i in range(6):
        pages.append((i, "http://a.org/p", f"<p>{notice}</p><p>{notice} Nr{i} costs euro.</p><p>Short{i}</p><p>{notice}</p>"))
        expected[i] = f"Nr{i} costs euro.\nShort{i}"
    # A page without anything of its own is a copy of others, and keeps its text.
    pages.append((9, "http://a.org/q", f"<p>{notice}</p>"))
    expected[9] = notice
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in extract_text(table).collect()} == expected


def test_url_rules(spark):
    rules = spark.createDataFrame(
        [("net", "/", "block"), ("example.net", "/en/", "allow"), ("a.org", "", "block"), ("a.org", "", "allow")],
        "host string, path string, verdict string",
    )
    urls = [None, "x", "http://Example.NET/en/1?q#f", "http://www.example.net/de", "http://net", "https://b.a.org", "ftp://aa.org/", "http://x.net/?"]
    pages = spark.createDataFrame([(i, u, "own") for i, u in enumerate(urls)] + [(7, urls[7], "own")], "page_id long, url string, rule string")
    found = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages, rules).fillna("-").collect())
    assert found == [
        (0, "", "", "-", "allow"), (1, "", "", "-", "allow"), (2, "example.net", "/en/1", "example.net/en/", "allow"),
        (3, "www.example.net", "/de", "net/", "block"), (4, "net", "", "-", "allow"), (5, "b.a.org", "", "a.org", "block"),
        (6, "aa.org", "/", "-", "allow"), (7, "x.net", "/", "net/", "block"), (7, "x.net", "/", "net/", "block"),
    ]


# ---- toxicity


def test_a_pair_may_mean_what_neither_word_does(spark):
    """Label 1 only where both words meet: no additive weights reach this."""
    rng, rows = random.Random(3), []
    for i in range(1500):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        rows.append((i, " ".join(["zorgle"] * a + ["fimble"] * b + rng.choices(["and", "the", "of"], k=3)), int(a != b)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    known = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    found = score_documents(docs, learn(docs, known)).where("held_out").collect()
    truth = {r[0]: r[2] for r in rows}
    assert np.mean([r.predicted == truth[r.doc_id] for r in found]) > 0.95


def test_scores_equal_explicit_sums_over_terms_and_pairs(spark):
    rng = random.Random(4)
    vocabulary = [f"{a}{b}" for a in ("insult", "group", "plain", "other") for b in range(6)]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 9)))) for i in range(400)]
    known = [(i, int("insult1" in t and "group" in t)) for i, t in docs]
    table = spark.createDataFrame([*docs, (900, None), (901, "unknown words")], "doc_id long, text string")
    model = learn(table, spark.createDataFrame(known, "doc_id long, toxic int"))
    column = {int(t): i for i, t in enumerate(model.terms)}
    assert len(column) > 30
    for r in score_documents(table, model).collect():
        text = dict(docs).get(r.doc_id, "unknown words" if r.doc_id == 901 else "")
        own = sorted({column[t] for w in words(text) for t in word_terms(w) if t in column})
        margin = model.bias + sum(model.weights[i] for i in own)
        margin += sum(float(model.factors[i] @ model.factors[j]) for i, j in itertools.combinations(own, 2))
        assert math.isclose(r.score, 1 / (1 + math.exp(-margin)), rel_tol=1e-6)


def test_one_kind_of_label_gives_the_prior(spark):
    docs = spark.createDataFrame([(i, "some text") for i in range(20)], "doc_id long, text string")
    clean = spark.createDataFrame([(i, 0) for i in range(20)], "doc_id long, toxic int")
    assert all(r.predicted == 0 for r in score_documents(docs, learn(docs, clean)).collect())


# ---- tokens and packing


def test_equal_pieces_without_ids_are_dealt_over_tasks(spark):
    docs = spark.createDataFrame([(None, "")] * 4000 + [(1, "a b c")], "doc_id long, text string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        packed = Scratch(spark, "test").write(pack(docs, WORDS), "packed")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert packed.count() == 4001
    per_bin = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.countDistinct("offset").alias("o"), F.count("*").alias("c"))
    assert all(r.n <= 4096 and r.o == r.c for r in per_bin.collect()) and packed.select("sequence_id").distinct().count() == 1
    dealt = packed.groupBy(F.col("_metadata.file_name")).count().collect()
    assert len(dealt) == 4 and max(r["count"] for r in dealt) < 1500


def test_word_tokenizer_equals_the_tokenizer():
    whole, ours = Tokenizer.from_file(WORDS), WordTokenizer(WORDS, 1)
    texts = [t or "" for _, t, _ in ODD] + ["Don't we'll 12ab...!! İI", "é ́x a\x1cb\x85c", "日本語 テスト", "a.b, c;d: É!?"]
    flat, ends = ours.encode(texts)
    for text, a, b in zip(texts, [0, *ends[:-1]], ends, strict=True):
        assert flat[a:b].tolist() == whole.encode(text, add_special_tokens=False).ids + [1]


@settings(max_examples=60, deadline=None)
@given(capacity=st.integers(1, 60), data=st.data())
def test_packing_by_histogram_equals_best_fit_decreasing(capacity, data):
    lengths = data.draw(st.lists(st.integers(1, capacity), max_size=150))
    counts = Counter(lengths)
    plan, rooms, places = best_fit_decreasing(counts, capacity), Counter(), {}
    for length, n in counts.items():
        sequence, offset = plan.place(np.full(n, length), np.arange(n))
        for s, o in zip(sequence.tolist(), offset.tolist(), strict=True):
            rooms[s] += length
            places.setdefault(s, []).append((o, length))
    assert sorted(capacity - used for used in rooms.values()) == best_fit(lengths, capacity)
    for members in places.values():
        assert all(o == sum(n for _, n in sorted(members)[:i]) for i, (o, _) in enumerate(sorted(members)))


@pytest.mark.parametrize("block", [6, 37, 1 << 19])
def test_boundaries_across_blocks(odd, block):
    by_block = {(r.doc_id, r.n_tokens) for r in token_counts(odd, PIECES, block_tokens=block).collect()}
    assert by_block == {(r.doc_id, r.n_tokens) for r in token_counts(odd, PIECES).collect()}


@pytest.mark.parametrize("file_bytes", [1, 3000, 1 << 28])
def test_token_files_are_bounded_by_bytes(spark, tmp_path, file_bytes):
    """Many long texts: files of a few of them, never one file of all."""
    docs = [(i, "some words of a text " * (i * 7 % 40)) for i in range(120)] + [(None, "long " * 3000)]
    table = spark.createDataFrame(docs, "doc_id long, text string").coalesce(2)
    write_token_files(table, PIECES, str(tmp_path / "ids"), file_bytes)
    found = {r.doc_id: r.n_tokens for r in scan_token_files(spark, str(tmp_path / "ids"), 500).collect()}
    assert found == {r.doc_id: r.n_tokens for r in token_counts(table, PIECES).collect()} and len(found) == 121
    sizes = [p.stat().st_size for p in (tmp_path / "ids").rglob("part-*")]
    most = max((found[i] + 6) * 2 for i in found)
    assert max(sizes) <= file_bytes + most and (len(sizes) == 2) == (file_bytes == 1 << 28)


# ---- mixing


@settings(max_examples=80, deadline=None)
@given(shares=st.lists(st.integers(0, 50).map(float), min_size=1, max_size=6), seats=st.integers(0, 120))
def test_apportionment_takes_the_highest_quotients(shares, seats):
    quotients = sorted((-s / (2 * k + 1), i) for i, s in enumerate(shares) if s for k in range(seats))[:seats]
    won = Counter(i for _, i in quotients)
    assert apportion(shares, seats) == [won[i] for i in range(len(shares))]


def test_shards_add_up_and_targets_stop_at_their_limit():
    sources = [Source("a", 10), Source("b", 1000), Source(None, 0), Source("d", 500)]
    shares = targets(sources, Mix())
    assert shares[0] == 30 and shares[2] == 0 and abs(sum(shares) - 1510) < 1e-9
    assert all(share <= 3 * s.size for share, s in zip(shares, sources, strict=True))
    assert [sum(q) for q in zip(*shard_quotas(shares, 188, 16), strict=True)] == apportion(shares, 188)


def test_words_taken_come_near_the_target(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randrange(60), rng.choice(["hot"] * 8 + ["cold", None])) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    first, again = (sorted(map(tuple, mix_documents(docs).fillna("-").collect())) for _ in range(2))
    assert first == again
    for source in {r[1] for r in first}:
        own = [r for r in first if r[1] == source]
        assert abs(sum(r[5] for r in own) - own[0][4]) <= Mix().block_words
        assert all(r[5] <= 3 * r[2] for r in own)


def test_rows_that_share_an_id_or_have_none_have_copies_of_their_own(spark):
    """A hot source from which the mix takes a part, and a small one that it repeats."""
    rows = [(None, f"{'w ' * 9}n{i}", "hot") for i in range(1000)]
    rows += [(7, f"{'w ' * 9}s{i % 50}", "hot") for i in range(500)] + [(i, "v " * 10, "small") for i in range(40)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, source string, copies string")
    plan = mix_documents(docs)
    wanted = {r.source: r.copies for r in plan.groupBy("source").agg(F.sum("copies").alias("copies")).collect()}
    mixed = mixed_rows(docs)
    assert mixed.columns == docs.columns
    assert {r.source: r["count"] for r in mixed.groupBy("source").count().collect()} == wanted
    assert wanted["hot"] < 1500 and wanted["small"] == 120
    target = plan.where("source = 'hot'").first().target
    assert abs(10 * wanted["hot"] - target) <= 20
    # Of rows without id, neither all nor the first by text or length.
    taken = [r.text for r in mixed.where("source = 'hot' AND doc_id IS NULL").collect()]
    assert len(taken) == len(set(taken)) and 0.5 < len(taken) / 1000 < 1


# ---- chats


TEXT = st.text(st.sampled_from("ab\\<>/ \ngt") | st.characters(codec="utf-8", exclude_characters="\x00"), max_size=12)
CONTROL = st.sampled_from(["</turn>", "<turn ", "\\", "\\g", "<\\/turn>", "<\\turn ", "### Assistant:", ">\n", "\n"])
ANY = st.lists(TEXT | CONTROL, max_size=5).map("".join)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(turns=st.lists(st.tuples(st.sampled_from(["user", "assistant", "system"]) | ANY, ANY), min_size=1, max_size=6))
def test_formatted_chats_read_back(spark, turns):
    rows = [(5, i, role, text, "own") for i, (role, text) in enumerate(turns)]
    chats = format_chats(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, formatted string"))
    read = chats.select(
        read_turns(F.col("formatted")).alias("turns"), learned_texts(F.col("formatted"), F.col("segments")).alias("learned"), "segments", "formatted"
    ).first()
    assert [tuple(t) for t in read.turns] == turns
    assert read.learned == [text for role, text in turns if role == "assistant"]
    assert [s.start for s in read.segments] == np.cumsum([0, *(s.length for s in read.segments)])[:-1].tolist()
    assert sum(s.length for s in read.segments) == len(read.formatted)


TEMPLATES = [
    Template(open="<|im_start|>", after_role="\n", close="<|im_end|>\n"),
    Template(open="[[", after_role="]] ", close=" (end).*+?\n"),
    Template(open="### ", after_role=":\n", close="$^{2}|x\n\n"),
    Template(open="<s>[INST", after_role="]", close="[/INST]</s>"),
]


@settings(max_examples=60, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=st.data(), template=st.sampled_from(TEMPLATES))
def test_any_template_reads_back(spark, data, template):
    marks = [template.open, template.after_role, template.close, template.close.strip(), "\\", template.close[:-2], template.open[1:]]
    text = st.lists(st.sampled_from(marks) | TEXT, max_size=5).map("".join)
    turns = data.draw(st.lists(st.tuples(st.sampled_from(["user", "assistant"]) | text, text), min_size=1, max_size=5))
    rows = [(None, i, role, text, "x") for i, (role, text) in enumerate(turns)]
    chats = format_chats(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, segments string"), template)
    columns = read_turns(F.col("formatted"), template), learned_texts(F.col("formatted"), F.col("segments"), template)
    (read,) = chats.select(columns[0].alias("turns"), columns[1].alias("learned")).collect()
    assert [tuple(t) for t in read.turns] == turns
    assert read.learned == [text for role, text in turns if role == "assistant"]


@pytest.mark.parametrize("marks", [{"close": "##\n"}, {"close": "abca"}, {"open": "<a>"}, {"close": "x\n"}, {"open": "<\\a"}])
def test_marks_that_could_not_be_read_back_are_refused(marks):
    refused = {**{"close": "</turn>"}, **marks}
    if refused["close"] == "##\n":
        Template(**{"close": "##\n"})  # it ends in a line feed, which tells it from its beginning
        return
    with pytest.raises(ValueError):
        Template(**refused)


def test_null_ids_and_turns_are_conversations_and_come_first(spark):
    rows = [(None, 2, "assistant", "b"), (None, None, "user", "a"), (1, 1, "user", None), (1, None, None, "c")]
    chats = format_chats(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    found = {r.conv_id: [tuple(t) for t in r.turns] for r in chats.select("conv_id", read_turns(F.col("formatted")).alias("turns")).collect()}
    assert found == {None: [("user", "a"), ("assistant", "b")], 1: [("", "c"), ("user", "")]}


@pytest.mark.parametrize(
    "roles,order",
    [("su", "open"), ("sua", "ok"), ("uaua", "ok"), ("uu", "broken"), ("as", "broken"), ("uata", "ok"), ("uat", "open"), ("uss", "broken"), ("u?", "broken")],
)
def test_turn_order(spark, roles, order):
    names = {"s": "system", "u": "user", "a": "assistant", "t": "tool", "?": None}
    rows = spark.createDataFrame([(1, i, names[r], None) for i, r in enumerate(roles)], "conv_id long, turn int, role string, text string")
    assert format_chats(rows).first().turn_order == order


# ---- near duplicates


def copies_of(rng, words, n, change):
    base = rng.choices(words, k=120)
    return [" ".join(w if rng.random() > change else rng.choice(words) for w in base) for _ in range(n)]


@pytest.mark.parametrize("change", [0.01, 0.03, 0.06])
def test_large_groups_lose_no_link(spark, monkeypatch, change):
    monkeypatch.setattr("orderloom.llm.near_dup.BLOCK", 16)
    rng = random.Random(int(1000 * change))
    words = [f"w{i}" for i in range(3000)]
    texts = copies_of(rng, words, 150, change) + copies_of(rng, words, 60, change)
    texts += [texts[0]] * 40 + [" ".join(rng.choices(words, k=50)) for _ in range(60)]
    rng.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs).collect()}
    assert found == near_components(enumerate(texts)) and BLOCK > 16


@pytest.mark.parametrize("sketch", [Sketch(bands=1, rows=128), Sketch(bands=2, rows=64), Sketch()])
def test_small_sets_that_share_no_band_are_linked(spark, sketch):
    """With few bands a single other shingle changes them all."""
    rng, texts = random.Random(8), []
    for base in range(30):
        own = [f"w{base}x{i}" for i in range(rng.randint(6, 12))]
        texts += [own, own[:-1], own[1:], [*own, "more"], own[:2] + own[3:]]
    docs = [(i, " ".join(t)) for i, t in enumerate(texts)]
    docs += [(None, "one two three four five six seven"), (None, "one two three four five six seven eight"), (900, "one two")]
    found = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), sketch).collect()
    named = {r.doc_id: (r.n_shingles, r.component_id) for r in found if r.doc_id is not None}
    expected = near_components([d for d in docs if d[0] is not None])
    if sketch.bands > 2:
        assert named == expected
    else:
        # Links that take a single shingle are all there; those of larger sets may need bands.
        small = {d for d, (n, _) in expected.items() if n <= 5}
        assert all(named[d] == expected[d] for d in small if expected[d][1] in small)
    assert [r.kept for r in found if r.doc_id is None].count(True) == 1


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 140)] + [(0, i) for i in range(1, 60)] + [(7, 7)]
    found = components(spark.createDataFrame(path, "u long, v long"), Scratch(spark, "components-test"))
    assert {r.node: r.component for r in found.collect()} == {**{i: 100 for i in range(100, 141)}, **{i: 0 for i in range(60)}}


def test_sketch_needs_a_power_of_two():
    with pytest.raises(ValueError):
        Sketch(bands=33).bucket_bits


# ---- neighbours


def test_vectors_that_take_no_part_and_copies(spark):
    good = [(i, [float(i % 13), float(i % 7), 1.0]) for i in range(300)]
    bad = [(1000, None), (1100, [0.0] * 3), (1200, [1.0, None, 1.0]), (1300, [float("nan"), 1.0, 1.0]), (1400, [float("inf"), 1.0, 1.0]), (1500, [1.0]), (None, [1.0] * 3)]
    copies = [(2000 + i, [5.0, 5.0, 5.0]) for i in range(150)]
    table = good + bad + copies
    rows = nearest_neighbours(spark.createDataFrame(table, "vec_id long, embedding array<double>"), F.col("vec_id") % 100 == 0).collect()
    points = {i: np.array(v) for i, v in good + copies}
    for query in [i for i in points if i % 100 == 0]:
        best = sorted((float(np.sqrt(((p - points[query]) ** 2).sum())), i) for i, p in points.items() if i != query)[:10]
        answers = sorted((r["rank"], r.score, r.vec_id) for r in rows if r.query_id == query)
        assert [(s, v) for _, s, v in answers] == best
    assert {r.query_id for r in rows} == {i for i in points if i % 100 == 0}


def test_repeated_ids_and_columns_that_clash(spark):
    """Rows that share a vec_id are candidates each; names of inner columns do not matter."""
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(60)]
    rows += [(7, rng.normal(size=4).tolist()), (7, rows[7][1]), (20, rows[5][1])]
    table = spark.createDataFrame(
        [(*r, 1, "x", 2.0, [1.0]) for r in rows], "vec_id long, embedding array<double>, node int, q string, d double, vec array<double>"
    )
    found = nearest_neighbours(table, F.col("vec_id") == 0, k=70).orderBy("rank").collect()
    apart = sorted((math.dist(v, rows[0][1]), i) for i, v in rows if i != 0)
    assert [(r.vec_id, round(r.score, 9)) for r in found] == [(i, round(a, 9)) for a, i in apart]
    assert {r.query_id for r in found} == {0} and [r["rank"] for r in found] == list(range(1, len(apart) + 1))


def test_few_vectors_give_all(spark):
    table = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.0])], "vec_id long, embedding array<float>")
    found = nearest_neighbours(table, F.col("vec_id") == 0).collect()
    assert sorted((r["rank"], r.vec_id) for r in found) == [(1, 2), (2, 1)]


# ---- helpers


def test_running_total_and_hot_join(spark):
    rows = spark.range(5000).selectExpr("IF(id % 3 = 0, 'hot', cast(id % 50 as string)) AS key", "id", "id % 4 AS value")
    total = running_total(rows, ["key"], F.col("value"), F.expr("id % 8"), ["id"], "before")
    for key in ("hot", "7"):
        own = sorted(total.where(F.col("key") == key).collect(), key=lambda r: (r.id % 8, r.id))
        assert [r.before for r in own] == np.cumsum([0, *(r.value for r in own)])[:-1].tolist()
    counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    assert join_counted(rows, counts, "key", "n").count() == 5000

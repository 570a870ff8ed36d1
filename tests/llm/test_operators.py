"""Each operator against a brute-force version, a library, a round trip or held-out rows."""

import base64
import hashlib
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from colloquy.llm import bpe_replay, chat_format, decontaminate, hamming_search, html_text, induced_sort, language, ngram_jaccard, quality, queries, repeated_text, staging, token_files

BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD = public_tokenizers.path("word_bpe_49k.json")
WORDS = [a + b for a in ("ba", "ke", "li", "mo", "nu") for b in ("ra", "se", "ti", "vo", "zu", "da")]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def make_docs(seed=3):
    """Near copies, exact copies, shared passages, and defined edge cases."""
    rng = random.Random(seed)
    base = [sentence(rng, rng.randint(60, 200)) for _ in range(12)]
    passage = sentence(rng, 120)
    texts = list(base)
    for t in base[:6]:
        w = t.split()
        for _ in range(6):
            v = list(w)
            for _ in range(rng.randint(1, 6)):
                v[rng.randrange(len(v))] = rng.choice(WORDS)
            texts.append(" ".join(v))
    texts += [base[0]] * 5 + [t[:300] + " " + passage + " " + t[300:600] for t in base[6:]]
    texts += [None, "", "  \n", "one", "one", "one two three", "a" * 3000, "a" * 3000 + "b", "x y " * 900]
    return [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def rows():
    return make_docs()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def brute_components(rows, k, percent):
    up = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, t, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(up))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in sets.items():
        for j, b in sets.items():
            if j < i and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize(("k", "percent"), [(4, 85), (5, 80)])
def test_jaccard(docs, rows, k, percent):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard.jaccard_components(docs, k, percent).collect()}
    assert got == brute_components(rows, k, percent)


def test_neighbours_past_an_unlike_set(spark, monkeypatch):
    """Of three sets of one size with a band in common, the alike first and last are paired, not each with the set between."""
    monkeypatch.setattr(ngram_jaccard, "BAND_SALTS", 1)
    reps = spark.createDataFrame([(1, 100, [5], *[0] * 4), (2, 100, [5], *[-1] * 4), (3, 100, [5], *[0] * 4)], "doc_id long, n int, bands array<long>, m0 long, m1 long, m2 long, m3 long")
    assert {frozenset(r) for r in ngram_jaccard._neighbours(reps, 85).collect()} == {frozenset((1, 3))}


def test_jaccard_members_of_a_group(spark, monkeypatch):
    """A and A' share prefix and size, only A' is near B: the cross pass alone must link it."""
    bands = ngram_jaccard._neighbours
    monkeypatch.setattr(ngram_jaccard, "_neighbours", lambda *a: bands(*a).where("false"))
    rng = random.Random(5)
    rare, common = [f"p{i}" for i in range(31)], [f"c{i}" for i in range(400)]
    first, second = common[:169], common[169:338]
    texts = [[*rare[:-1], "b", *second], [*rare, *first], [*rare, *second]]
    texts += [rng.sample(common, 300) + [f"f{j}x{i}" for i in range(200)] for j in range(30)]  # make the common words frequent
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 1, 85).collect()}
    assert got == brute_components(rows, 1, 85) and got[2][1] == 0 and got[1][1] == 1


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=1, max_size=80), st.sampled_from([4, 20, 400]), st.sampled_from([7, 10**6]))
def test_suffix_order(symbols, depth, limit):
    order, common = induced_sort.suffix_order(np.array(symbols, np.uint16), depth, limit)
    assert sorted(order.tolist()) == list(range(len(symbols)))
    for a, b, c in zip(order, order[1:], common[1:]):
        x, y = symbols[a:], symbols[b:]
        assert x[:depth] <= y[:depth]
        n = next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
        assert c == min(n, depth)


def brute_cut(rows, length):
    raw = [(t or "").encode() for _, t, *_ in rows]
    seen = Counter(t[i : i + length] for t in raw for i in range(len(t) - length + 1))
    out = {}
    for (i, *_), t in zip(rows, raw):
        gone = np.zeros(len(t), bool)
        for j in range(len(t) - length + 1):
            if seen[t[j : j + length]] > 1:
                gone[j : j + length] = True
        starts = int((gone & ~np.append(False, gone[:-1])).sum()) if len(t) else 0
        out[i] = (len(t), int(gone.sum()), starts, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest())
    return out


@pytest.mark.parametrize("length", [100, 400])
def test_repeats(docs, rows, length):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeated_text.cut_repeats(docs, length).collect()}
    assert got == brute_cut(rows, length)


def test_repeats_large_groups(spark, monkeypatch):
    """One passage with ever different ends: its groups of equal cores are divided down to single windows."""
    monkeypatch.setattr(repeated_text, "KEY_ROWS", 2)
    keep, names = staging.Stages.keep, []
    monkeypatch.setattr(staging.Stages, "keep", lambda self, df, name="t": names.append(name) or keep(self, df, name))
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    common = word(130)
    texts = [word(60) + common[rng.randrange(40) : 130 - rng.randrange(40)] + word(60) for _ in range(60)]
    texts += [t[20:150] + rng.choice("xyz") + t[150:] for t in texts[:20]] + [common[: 60 + i] + "z" * i + common[60 + i :] for i in range(0, 60, 3)] + texts[:3]
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeated_text.cut_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 50).collect()}
    assert got == brute_cut(rows, 50) and names.count("pieces") > 2


def test_repeats_text(docs, rows):
    out = repeated_text.cut_repeats(docs.withColumnRenamed("source", "n_spans"), 100, with_text=True).collect()
    assert {r.doc_id: hashlib.sha256(r.text.encode()).hexdigest() for r in out} == {i: v[3] for i, v in brute_cut(rows, 100).items()}
    texts = {i: (t or "").encode() for i, t, *_ in rows}
    for r in out:
        edges = [0, *(x for s in r.removed for x in s), r.n_bytes]
        assert b"".join(texts[r.doc_id][a:b] for a, b in zip(edges[::2], edges[1::2])) == r.text.encode()


@pytest.mark.parametrize("in_task", [0, 1 << 20])
def test_components(spark, monkeypatch, in_task):
    """Links of both kinds of passes; few links need no rounds, each of which is written."""
    monkeypatch.setattr(staging, "LINKS_IN_TASK", in_task, raising=False)
    rng = random.Random(6)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(i, i + 1) for i in range(100, 130)]
    parent = {x: x for link in links for x in link}

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    stages = staging.Stages(spark)
    got = {r.node: r.component for r in staging.components(stages, spark.createDataFrame(links, "a long, b long")).collect()}
    alone = parent.keys() - {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: find(x) for x in parent.keys() - alone}
    assert in_task == 0 or stages.count == 0


@pytest.mark.parametrize("dealt", [None, ["b"]])
def test_keep_shared(spark, dealt):
    """Lone keys go, however the rows of a key are dealt; one key holds a third of all rows."""
    rng = random.Random(3)
    rows = [(rng.randrange(2000), i) for i in range(2000)] + [(-5, i) for i in range(1000)]
    times = Counter(a for a, _ in rows)
    df = spark.createDataFrame(rows, "a long, b long").repartition(5)
    got = sorted(map(tuple, staging.keep_shared(df, "a", dealt).collect()))
    assert got == sorted(r for r in rows if times[r[0]] > 1)


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import tiktoken

    with open(BPE, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(text=st.text(alphabet=st.one_of(st.sampled_from(list("aab tthe'sing \n\t\r.,!1　\x85\x1c")), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_bpe_text(tiktoken_encoding, text):
    bpe = bpe_replay.load(bpe_replay.read_ranks(BPE), public_tokenizers.PATTERN)
    raw = np.frombuffer(text.encode(), np.uint8)
    parts = list(bpe.encode(raw, np.array([0, len(raw)], np.int64)))
    ids = np.concatenate([p[2] for p in parts])
    assert ids.tolist() == tiktoken_encoding.encode_ordinary(text)
    assert bpe.decode(ids)[0].tobytes() == text.encode()


def test_bpe_documents(docs, rows, tiktoken_encoding):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe_replay.encode_documents(docs, BPE, public_tokenizers.PATTERN).collect()}
    for i, t, *_ in rows:
        ids = tiktoken_encoding.encode_ordinary(t or "")
        assert got[i] == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=30), max_size=6))
def test_block_round_trip(lists):
    counts = np.array([len(x) for x in lists], np.int64)
    ids = np.array([i for x in lists for i in x], np.uint32)
    keys, nulls = np.arange(len(lists)), np.array([i % 2 == 1 for i in range(len(lists))], bool)
    a, b, c, d = token_files.unpack(token_files.pack(keys, nulls, counts, ids))
    assert a.tolist() == keys.tolist() and b.tolist() == nulls.tolist() and c.tolist() == counts.tolist() and d.tolist() == ids.tolist()


def test_many_ranks_round_trip():
    ids = np.arange(70_000, dtype=np.uint32)[::-1].copy()
    assert token_files.unpack(token_files.pack(np.zeros(1, int), np.zeros(1, bool), np.array([70_000]), ids))[3].tolist() == ids.tolist()


def test_token_files(spark, docs, rows, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORD)
    token_files.write_token_files(docs, WORD, str(tmp_path / "t"))
    got = {r.doc_id: r for r in token_files.read_token_files(spark, str(tmp_path / "t"), with_ids=True).collect()}
    start = 0
    for i, t, *_ in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        assert (got[i].start, got[i].n_tokens, got[i].ids) == (start, len(ids), ids)
        assert got[i].ids_crc32 == zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
        start += len(ids)


def test_token_files_added_tokens(spark, tmp_path):
    """Added tokens in a text, against the library as it is."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORD)
    texts = ["see <|endoftext|> here", "See<|endoftext|>HERE it's", "<|startoftext|><|endoftext|>", "<|ENDOFTEXT|> a<|EndOfText|>b", "É<|endoftext|>É don't", "plain <|endoftext| >", "<|endof", "text|>", "end<|startoftext|>", "see here"]
    token_files.write_token_files(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), WORD, str(tmp_path / "t"))
    got = {r.doc_id: r.ids for r in token_files.read_token_files(spark, str(tmp_path / "t"), with_ids=True).collect()}
    assert got == {i: [*library.encode(t, add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}


def brute_align(item, passage):
    best, above = 0, [0] * (len(passage) + 1)
    for w in item:
        row = [0]
        for j, v in enumerate(passage):
            row.append(max(0, above[j] + (2 if v == w else -1), above[j + 1] - 1, row[j] - 1))
        best, above = max(best, *row), row
    return best


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=12), st.lists(st.lists(st.integers(1, 4), max_size=20), min_size=1, max_size=4))
def test_alignment(item, passages):
    got = decontaminate.align(np.array(item, np.uint64), [np.array(p, np.uint64) for p in passages])
    assert [s for s, _ in got] == [brute_align(item, p) for p in passages]


def test_decontamination(spark):
    rng = random.Random(8)
    items = [(i, sentence(rng, 40)) for i in range(6)] + [(6, "one two"), (7, None), (8, "")]
    texts = []
    for i in range(6):
        words = items[i][1].split()
        edited = [w if rng.random() > 0.12 else rng.choice(WORDS) for w in words]
        texts += [(10 * i, sentence(rng, 200) + " " + items[i][1].upper() + ". " + sentence(rng, 50)), (10 * i + 1, sentence(rng, 80) + " " + " ".join(edited)), (10 * i + 2, sentence(rng, 400))]
    texts += [(90, "says one, Two here"), (91, None), (92, ""), (None, items[0][1])]
    found = decontaminate.contaminated(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    assert got == {(10 * i + e, i) for i in range(6) for e in (0, 1)} | {(90, 6), (None, 0)}


@pytest.mark.parametrize("whole", [False, True])
@pytest.mark.parametrize("share", [0.2, 0.25, 0.3])
def test_decontamination_edited(spark, share, whole):
    """Copies with many words replaced, as the only ones or beside a whole copy of each item."""
    rng = random.Random(17)
    items = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(40))) for i in range(40)]
    texts, expected = [], set()
    for i, t in items:
        item = t.split()
        edited = [f"v{rng.randrange(10**6)}" if rng.random() < share else w for w in item]
        texts += [(2 * i, sentence(rng, 80) + " " + " ".join(edited) + " " + sentence(rng, 50))] + [(2 * i + 1, t)] * whole
        n_seeds = sum(edited[j : j + 3] == item[j : j + 3] for j in range(38))
        if n_seeds >= 2 and brute_align(item, edited) >= 40:
            expected.add((2 * i, i))
        expected |= {(2 * i + 1, i)} if whole else set()
    assert len(expected) >= 25 * (1 + whole)
    found = decontaminate.contaminated(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == expected


def test_quality_held_out(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    scored = quality.score(docs, quality.fit(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in scored]) >= 0.9


def test_language_held_out(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = language.predict(docs, language.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) >= 0.97


def brute_language(model_words, text):
    """Log scores by words, else by the longest known n-grams of characters, one by one."""
    languages = sorted({x for x, _, _ in model_words})
    words, grams = defaultdict(lambda: [0] * len(languages)), [defaultdict(lambda: [0] * len(languages)) for _ in range(5)]
    for x, w, n in model_words:
        w = w.decode()
        words[w][languages.index(x)] += n
        marked = "\x02" + w + "\x03"
        for k in range(1, 5):
            for i in range(len(marked) - k + 1):
                grams[k][marked[i : i + k]][languages.index(x)] += n
    log = lambda table, key, k: np.log(table[key][k] + 0.5) - np.log(sum(v[k] for v in table.values()) + 0.5 * len(table))
    out = np.zeros(len(languages))
    for w in re.findall(r"[^\W\d_]+", text.lower()):
        for k in range(len(languages)):
            if w in words:
                out[k] += log(words, w, k)
                continue
            marked = "\x02" + w + "\x03"
            for i in range(len(marked)):
                n = next((n for n in range(min(4, i + 1), 0, -1) if marked[i + 1 - n : i + 1] in grams[n]), 0)
                out[k] += log(grams[n], marked[i + 1 - n : i + 1], k) if n else 0
    return out


def test_language_brute():
    words = [("de", "straße".encode(), 4), ("de", b"und", 9), ("en", b"the", 9), ("en", b"street", 3), ("zh", "漢字文".encode(), 5), ("zh", "文字".encode(), 2)]
    model = language.Model.of_words(["de", "en", "zh"], words)
    for text in ("the straße", "strasse undo", "漢字 文漢", "theta 文字文 x", "zzz"):
        raw = np.frombuffer(text.encode(), np.uint8)
        got, _ = model.score(raw, np.array([0, len(raw)], np.int64))
        assert got[0] == pytest.approx(brute_language(words, text), abs=1e-4)


def test_language_rare(spark):
    """A language of three documents beside thousands of another is learned."""
    rows = [(i, "the and of that", "en") for i in range(4000)] + [(5000 + i, "och det att som", "sv") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in language.predict(docs, language.fit(docs, sample=50)).collect()}
    assert {got[i] for i in range(4000)} == {"en"} and {got[5000 + i] for i in range(3)} == {"sv"}


def test_votes_brute():
    """Votes against all cosines sorted one by one."""
    rng = np.random.default_rng(1)
    rows = np.abs(rng.standard_normal((60, quality.TERMS + quality.SHARES))).astype(np.float32)
    labels = (np.arange(60) % 3 == 0).astype(int)
    voter = quality.Voter(rows.copy(), labels, {0: 0.4, 1: 0.6})
    asked = np.abs(rng.standard_normal((20, rows.shape[1]))).astype(np.float32)
    v = (asked * voter.weights - voter.mean) @ (voter.axes / voter.weights[:, None].clip(1e-9))
    for r, s in enumerate(voter.score(asked)):
        cosine = np.array([v[r] @ w / np.linalg.norm(v[r]) for w in voter.vectors])
        near = np.argsort(-cosine)[: quality.NEIGHBOURS]
        weight = np.maximum(cosine[near], 0) ** 4 * np.where(labels[near] == 1, 0.6 / 20, 0.4 / 40)
        assert s == pytest.approx((weight * labels[near]).sum() / weight.sum(), abs=1e-3)


def test_language_letters(spark):
    model = language.Model.of_words(["en", "fr"], [("en", b"the", 5), ("fr", b"le", 5)])
    rows = [(1, None), (2, ""), (3, "12 !?"), (4, "the the"), (5, "—"), (6, "漢字"), (None, "le")]
    got = {r.doc_id: (r.lang_pred, r.held_out is not None) for r in language.predict(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert [got[i][0] for i in (1, 2, 3, 5)] == ["und"] * 4 and got[4][0] == "en" and got[6][0] != "und" and got[None][0] == "fr"


def test_labeller():
    model, rng = html_text.trained(), random.Random(1234)
    right = total = 0
    for _ in range(150):
        page, labels = html_text.make_page(rng)
        got = model.label([html_text.blocks(page)])[0]
        right, total = right + (got == np.array(labels, bool)).sum(), total + len(labels)
    assert right / total > 0.99


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        (None, []),
        ("", []),
        ("plain &amp; text", ["plain & text"]),
        ("<p>a\n  b&nbsp;c<p>d<br>e", ["a b c", "d", "e"]),
        ("<script>var t='</p>';</script><p>x</p><!-- <p>no</p> --><style>p{}</style>", ["x"]),
        ("<p>1 < 2</p>", ["1 < 2"]),
        ("<p title='a>b'>x</p><p class=\"un", ["x"]),
        ("<p>cut &am", ["cut &am"]),
        ("<div>" * 40 + "<p>deep", ["deep"]),
    ],
)
def test_blocks(page, expected):
    assert [b.text for b in html_text.blocks(page)] == expected


def test_extract_pages(spark, sf):
    """Against the article element of the tables' pages, which the labeller never saw."""
    right = said = true = 0
    for r in html_text.extract(spark.read.parquet(f"{sf}/pages.parquet")).join(spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "html"), "page_id").collect():
        article = re.search(r"(?s)<article>(.*?)(?:</article>|$)", r.html or "")
        if article:
            inner = re.sub(r'(?s)<!--.*?-->|<div class="(?:ad|comment)[^>]*>.*?</div>', " ", article.group(1))
            expected = Counter(" ".join(b.text for b in html_text.blocks(inner)).split())
            got = Counter(r.text.split())
            right, said, true = right + sum((got & expected).values()), said + sum(got.values()), true + sum(expected.values())
    assert right > 0.97 * said and right > 0.97 * true


def test_extract_bare(spark):
    got = html_text.extract(spark.createDataFrame([(1, "u", "<p>x</p>"), (2, "u", "<p>" + "long words of a text " * 40 + "</p><p>more</p>")], "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text[:4] for r in got} == {1: "x", 2: "long"}


def test_extract(spark):
    page = '<html><body><nav><a href="/">home</a></nav><article><h1>Title</h1><p>First.</p><p>Second &lt;b&gt;</p></article><footer>&copy; me</footer></body></html>'
    got = html_text.extract(spark.createDataFrame([(1, "u", page), (2, None, None), (None, "v", "")], "page_id long, url string, html string")).collect()
    assert {(r.page_id, r.text, r.n_chars) for r in got} == {(1, "Title\nFirst.\nSecond <b>", 23), (2, "", 0), (None, "", 0)}


def test_nearest(spark):
    rng = np.random.default_rng(2)
    v = rng.standard_normal((600, 24)) * rng.uniform(0.5, 2, (600, 1))
    v[100:160] = v[3]
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)]
    rows += [(700, None), (720, [0.0] * 24), (740, [float("nan")] * 24), (760, [None] * 24), (780, [1.0, 2.0]), (None, rows[0][1])]
    found = hamming_search.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=10, every=20).collect()
    by = defaultdict(list)
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        by[r.query_id].append((r.vec_id, r.score))
    hits = 0
    for q in range(0, 600, 20):
        score = (v * v[q]).sum(axis=1)
        order = [i for i in np.lexsort((np.arange(600), -score)) if i != q][:10]
        hits += len({i for i, _ in by[q]} & set(order))
        for i, s in by[q]:
            assert s == pytest.approx(score[i], abs=1e-12)
    assert hits >= 0.9 * 300 and set(by) == set(range(0, 600, 20))


def recall_at_k(spark, v, k, every=20):
    found = hamming_search.nearest(spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(v)], "vec_id long, embedding array<double>"), k=k, every=every).collect()
    got = defaultdict(set)
    for r in found:
        got[r.query_id].add(r.vec_id)
    hits = []
    for q in range(0, len(v), every):
        score = v @ v[q]
        score[q] = -np.inf
        hits.append(len(got[q] & set(np.argpartition(-score, k)[:k].tolist())))
    return sum(hits) / (k * len(hits))


@pytest.mark.parametrize("length", [2, 10])
def test_nearest_longest_outside_sample(spark, length):
    """More rows than the sample holds; the one longest vector is not in it."""
    rng = np.random.default_rng(4)
    v = rng.standard_normal((8_000, 64))
    v /= np.sqrt((v**2).sum(axis=1, keepdims=True))
    ids = spark.range(len(v)).selectExpr("id", f"shiftrightunsigned(xxhash64(id, 5), 1) <= {(2**63 - 1) * hamming_search.SAMPLE_ROWS // len(v)} as sampled")
    outside = ids.where("not sampled and id % 20 <> 0").first().id
    v[outside] *= length
    assert recall_at_k(spark, v, 20) >= 0.9


@pytest.mark.parametrize("shard_rows", [20_000, 150])
def test_nearest_all_of_k(spark, monkeypatch, shard_rows):
    """Queries far from tight clusters, and tables of few vectors, still get k rows or all candidates."""
    monkeypatch.setattr(hamming_search, "SHARD_ROWS", shard_rows)
    rng = np.random.default_rng(6)
    v = np.repeat(rng.standard_normal((12, 32)), 50, axis=0) + 0.01 * rng.standard_normal((600, 32))
    v[::100] = rng.standard_normal((6, 32))
    for n in (600, 25, 12):
        found = hamming_search.nearest(spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(v[:n])], "vec_id long, embedding array<double>"), k=20, every=20).collect()
        by = defaultdict(set)
        for r in found:
            by[r.query_id].add((r.rank, r.vec_id))
        assert {q: len(x) for q, x in by.items()} == {q: min(20, n - 1) for q in range(0, n, 20)}
        assert all(sorted(r for r, _ in x) == list(range(1, len(x) + 1)) and len({i for _, i in x} - {q}) == len(x) for q, x in by.items())


def brute_repair(roles):
    """Least cost over all relabellings and cuts, by trying them all."""
    best = None

    def go(i, state, cost):
        nonlocal best
        if best is not None and cost >= best:
            return
        if i == len(roles):
            end = {-1: 0 if not roles else 99, 0: 6, 1: 3, 2: 0, 3: 3}[state]
            best = cost + end if best is None else min(best, cost + end)
            return
        for r, name in enumerate(chat_format.ROLES):
            if name == "tool" and roles[i] != "tool":
                continue
            price = cost + (0 if roles[i] == name else 2)
            if state == r:
                go(i + 1, r, price + 1)
            if (state, r) in chat_format.FOLLOWS:
                go(i + 1, r, price)
            for b in (1, 2):
                if (state, b) in chat_format.FOLLOWS and (b, r) in chat_format.FOLLOWS:
                    go(i + 1, r, price + 3)
                for c in (1, 2):
                    if (state, b) in chat_format.FOLLOWS and (b, c) in chat_format.FOLLOWS and (c, r) in chat_format.FOLLOWS:
                        go(i + 1, r, price + 6)

    go(0, -1, 0)
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["system", "user", "assistant", "tool", None]), max_size=6))
def test_repair_cost(roles):
    cost, turns, *_ = chat_format.repair(roles)
    assert cost == brute_repair(roles)
    assert [p for _, places in turns for p in places] == list(range(len(roles)))
    states = [-1, *(r for r, _ in turns)]
    assert all(s in chat_format.FOLLOWS for s in zip(states, states[1:])) and (states[-1] == 2 or not roles)


def format_rows(spark, rows):
    return chat_format.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()


def test_chats(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", None), (2, None, "user", "x"), (None, 0, None, "y"), (3, 0, "user", "say <|im_end|>"), (3, 1, "assistant", "call"), (3, 2, "tool", "result"), (3, 3, "assistant", "done")]
    got = {r.conv_id: r for r in chat_format.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got[1].rendered == "<|im_start|>user\na\n\nb<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n" and got[1].n_merged == 1
    assert got[2].n_inserted == 1 and got[None].n_turns == 1
    assert got[3].cost == 0 and got[3].rendered.count("<|im_end|>") == 4 and "say <|im_end |>" in got[3].rendered
    several = format_rows(spark, [(None, i, "user", f"t{i}") for i in range(5)])
    assert len(several) == 5 and all(r.n_turns == 1 for r in several)


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([], "item_id long, text string")
    assert ngram_jaccard.jaccard_components(none).count() == 0
    assert repeated_text.cut_repeats(none).count() == 0
    assert quality.score(none, quality.fit(none, labels)).count() == 0
    assert language.predict(none, language.fit(none)).count() == 0
    assert decontaminate.contaminated(none, items).count() == 0
    assert bpe_replay.encode_documents(none, BPE, public_tokenizers.PATTERN).count() == 0
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    assert hamming_search.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert chat_format.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_nulls_and_clashes(spark):
    """Null ids and texts, repeated rows, and extra columns with the operators' own names."""
    rows = [(None, None, 1), (None, "a b c d e f", 2), (1, "a b c d e f", 3), (1, "a b c d e f", 3), (2, None, 4)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, n int").selectExpr("*", "n as score", "n as t1", "n as spans", "n as held_out", "n as component_id", "'en' as lang")
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in ngram_jaccard.jaccard_components(odd).collect())
    assert got == [("1", 2, "1"), ("1", 2, "1"), ("2", 0, "2"), ("None", 0, "None"), ("None", 2, "1")]
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None)], "doc_id long, quality int")
    assert quality.score(odd, quality.fit(odd, labels)).count() == 5
    assert quality.score(odd, quality.fit(odd, labels), keep=True).count() == 5
    assert language.predict(odd, language.fit(odd)).count() == 5
    assert repeated_text.cut_repeats(odd, 5, with_text=True).count() == 5
    assert bpe_replay.encode_documents(odd, BPE, public_tokenizers.PATTERN).count() == 5


def test_queries_registered(spark):
    assert [n.split("_")[0] for n in queries.queries()] == [f"op{i}" for i in range(1, 11)]


def test_jaccard_sql(spark, sf):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    expected = sorted(con.execute(queries.oracle_sql()["op1_ngram_jaccard_join"]).fetchall())
    got = queries.queries()["op1_ngram_jaccard_join"](spark, sf).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == expected

"""Near-duplicates, mixing, chat, archives, pages and the pipeline."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from test_nearcopies import slow_ids
from test_texts import library, slow_fertility, slow_rules, slow_verdict

from conftest_llm import SF
from tideline.llm import chat, embeddings, html, language, mixing, queries, simhash, warc
from tideline.llm.common import fold, join_hot, table
from tideline.llm.components import connected_components, forest
from tideline.session import new_path


def slow_components(nodes, linked):
    label = {n: n for n in nodes}

    def root(n):
        while label[n] != n:
            n = label[n]
        return n

    for a, b in linked:
        a, b = root(a), root(b)
        label[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)] + [(k, k + 1) for k in range(400, 470)]
    links += [(500, k) for k in range(501, 560)] + [(7, 7), (None, 3), (3, None)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "a long, b long").repartition(5), "a", "b").collect()}
    clean = [(a, b) for a, b in links if a is not None and b is not None and a != b]
    assert got == slow_components({n for pair in clean for n in pair}, clean)
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_forest_connects_the_same():
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 60, 50), rng.integers(0, 60, 50)
    p, q = forest(a, b)
    nodes = set(a.tolist()) | set(b.tolist())
    assert slow_components(nodes, zip(a.tolist(), b.tolist())) == slow_components(nodes, zip(p.tolist(), q.tolist()))


def slow_fingerprint(text, size=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in low.replace("\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(rows):
    prints = {t: slow_fingerprint(t) for t in {r["text"] for r in rows}}
    linked = [(p, q) for p in set(prints.values()) for q in set(prints.values()) if p < q and (p ^ q).bit_count() <= 4]
    groups = slow_components(set(prints.values()), linked)
    lowest = {}
    for r in rows:
        g = groups[prints[r["text"]]]
        if r["doc_id"] is not None:
            lowest[g] = min(lowest.get(g, r["doc_id"]), r["doc_id"])
    return [(r["doc_id"], f"{prints[r['text']]:016x}", lowest.get(groups[prints[r["text"]]])) for r in rows]


@pytest.mark.parametrize("which", ["docs", "no_docs", "given"])
def test_simhash_groups_equal_brute_force(request, spark, which):
    source = table(spark, SF, "documents") if which == "given" else request.getfixturevalue(which)
    got = [tuple(r) for r in simhash.near_duplicates(source).collect()]
    assert Counter(got) == Counter(slow_groups(source.collect()))


def test_hot_keys_join_like_the_others(spark):
    rows = spark.createDataFrame([(k, k % 7 if k % 3 else 0) for k in range(100)] + [(100, None)], "id long, fp long")
    small = rows.where("fp is not null").groupBy("fp").agg(F.min("id").alias("low"), F.count("*").alias("n"))
    want = Counter(tuple(r) for r in rows.join(small, "fp").select("id", "fp", "low").collect())
    for share in (1, 3, 1000):
        joined = join_hot(rows, small, "fp", "n", share).select("id", "fp", "low")
        assert Counter(tuple(r) for r in joined.collect()) == want and sum(want.values()) == 100
    assert join_hot(rows.limit(0), small.limit(0), "fp", "n").count() == 0


@pytest.mark.parametrize("distance", [1, 3, 4, 6])
def test_fingerprint_links_lose_none(spark, distance):
    rng = random.Random(distance)
    base = [rng.getrandbits(64) for _ in range(25)]
    marks = set(base)
    for b in base:
        for _ in range(8):
            flips = rng.sample(range(64), rng.randrange(distance + 2))
            marks.add(b ^ sum(1 << f for f in flips))
    signed = [m - (1 << 64) if m >> 63 else m for m in marks]
    fps = spark.createDataFrame([(s,) for s in signed], "fp long")
    got = Counter((min(r["a"], r["b"]), max(r["a"], r["b"])) for r in simhash.fingerprint_links(fps, distance).collect())
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= distance}
    assert set(got) == want and set(got.values()) <= {1}


# ---- vectors ----


def slow_vectors(rows, dims, threshold=0.95):
    unit = []
    for _, v in rows:
        ok = v is not None and len(v) == dims and None not in v and np.isfinite(np.array(v, float)).all() and any(v)
        unit.append(np.array(v, float) / np.linalg.norm(v) if ok else None)
    near = [(i, j) for i in range(len(rows)) for j in range(len(rows)) if i != j and unit[i] is not None and unit[j] is not None and unit[i] @ unit[j] >= threshold]
    label = slow_components(range(len(rows)), [(i, j) for i, j in near if i < j])
    out = []
    for k, (vec_id, _) in enumerate(rows):
        ids = [rows[m][0] for m in range(len(rows)) if label[m] == label[k]]
        out.append((vec_id, sum(i == k for i, _ in near), min(ids), vec_id == min(ids)))
    return out


@pytest.mark.parametrize("group,tile", [(8192, 1024), (40, 16)])
def test_vectors_equal_brute_force(spark, monkeypatch, group, tile):
    monkeypatch.setattr(embeddings, "GROUP", group)
    monkeypatch.setattr(embeddings, "TILE", tile)
    rng = np.random.default_rng(7)
    base = rng.standard_normal((60, 24))
    rows = [(k, v.tolist()) for k, v in enumerate(base)]
    rows += [(100 + k, (base[k % 9] + 0.05 * rng.standard_normal(24)).tolist()) for k in range(60)]
    rows += [(200, base[0].tolist()), (200, base[0].tolist()), (201, (3 * base[0]).tolist()), (202, None), (203, [])]
    rows += [(204, [0.0] * 24), (205, [float("nan")] * 24), (206, [None] + [1.0] * 23), (207, [float("inf")] + [1.0] * 23), (208, [1.0, 2.0])]
    rows += [(209, [1e-300] * 24), (210, [1e-300] * 24)]
    frame = spark.createDataFrame([(i, v, "a", 1) for i, v in rows], "vec_id long, embedding array<double>, unit string, n int")
    got = [tuple(r) for r in embeddings.near_duplicates(frame).collect()]
    assert Counter(got) == Counter(slow_vectors(rows, 24))
    assert embeddings.near_duplicates(frame.where("false")).count() == 0


def test_near_pairs_at_the_threshold():
    rng = np.random.default_rng(1)
    a = rng.standard_normal((200, 40)) * np.linspace(3, 0.1, 40)
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    for threshold in (0.3, 0.8, 0.95):
        i, j = embeddings.near_pairs(a, a, threshold)
        assert set(zip(i.tolist(), j.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(a @ a.T >= threshold))))


@pytest.mark.parametrize("dims", [2, 3, 4, 8, 9, 12])
def test_no_pair_at_the_threshold_is_lost(dims):
    """Pairs whose cosine is exactly the threshold, in any number of components, before and after a rotation."""
    rng = np.random.default_rng(dims)
    v = rng.integers(-3, 4, (400, dims)).astype(float)
    v = v[np.abs(v).sum(axis=1) > 0]
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    turn, _ = np.linalg.qr(rng.standard_normal((dims, dims)))
    products = np.einsum("nd,md->nm", v, v)
    values, times = np.unique(np.round(products[(products > 0.5) & (products < 0.98)], 12), return_counts=True)
    threshold = float(products.flat[np.abs(products - values[times.argmax()]).argmin()])  # the commonest product
    order = np.argsort((v @ turn)[:, 0], kind="stable")
    v = v[order]
    got = set()
    for i, j in embeddings.compare(v @ turn, v @ turn, threshold, True, v, v):
        got |= set(zip(i.tolist(), j.tolist()))
    i, j = np.triu_indices(len(v), 1)
    product = np.einsum("nd,nd->n", v[i], v[j])
    sure, tie = product >= threshold + 1e-12, np.abs(product - threshold) < 1e-12
    pairs = lambda some: set(zip(i[some].tolist(), j[some].tolist()))
    assert pairs(sure) <= got <= pairs(sure | tie) and tie.sum() > 5
    # a tie is what its product on the unrotated vectors says, up to the rounding of that one product
    assert len(got & pairs(tie)) >= 0.9 * (tie & (product >= threshold)).sum()


def test_groups_by_ranges(spark, monkeypatch):
    """Far ranges are not compared, hot ranges are dealt on, and links are those of all pairs."""
    monkeypatch.setattr(embeddings, "GROUP", 30)
    monkeypatch.setattr(embeddings, "SMALL_GROUP", 20)
    rng = np.random.default_rng(3)
    base = np.eye(6)[:3].repeat(100, axis=0) * rng.choice([-1.0, 1.0], (300, 1))
    vectors = base + 0.12 * rng.standard_normal((300, 6)) * (np.arange(300) % 3 > 0)[:, None]
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert Counter(map(tuple, embeddings.near_duplicates(frame).collect())) == Counter(slow_vectors(rows, 6))


# ---- mixing ----


def test_mixing_edge_cases(docs, no_docs):
    weights = {"src0": 0.3, "src1": 0.5, "gone": 0.1, mixing.REST: 0.1}
    first, again = (sorted(map(tuple, mixing.mixed(docs, weights).collect()), key=str) for _ in range(2))
    assert first == again
    assert mixing.mixed(docs, weights).columns == [c for c in docs.columns if c != "copy"] + ["copy", "order_key"]
    assert mixing.mixed(no_docs, weights).count() == 0 and mixing.mixed(docs, {}).count() == 0
    assert mixing.mixed(docs.where("text is null"), weights).count() == 0


def test_mixing_meets_its_targets(spark):
    rows = [(k, "x" * (50 + k % 100), f"s{0 if k % 3 else k % 5}") for k in range(20_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weights = {"s0": 0.25, "s1": 0.5, mixing.REST: 0.25}
    mixed = mixing.mixed(frame, weights, epochs=1.5)
    whole = sum(len(t) for _, t, _ in rows)
    sizes = Counter()
    for r in mixed.select("source", F.length("text").alias("n")).collect():
        sizes[r["source"] if r["source"] in ("s0", "s1") else None] += r["n"]
    for g, w in weights.items():
        assert sizes[g] == pytest.approx(1.5 * whole * w, rel=0.05)
    s1 = mixed.where("source = 's1'").groupBy("doc_id").count().agg(F.max("count"), F.count("*")).first()
    n, rate = sum(s == "s1" for _, _, s in rows), mixing.rates(frame, weights, 1.5)["s1"]
    assert s1[0] > rate and s1[1] == pytest.approx(n * (1 - np.exp(-rate)), rel=0.05)
    assert not any("Python" in x or "Arrow" in x for x in [mixed._jdf.queryExecution().executedPlan().toString()])


def slow_poisson(key, rate, seed):
    """Copies of one row: equal parts of at most 64, each by adding up probabilities at a number of its own."""
    parts, out = max(1, -(-rate // 64)), []
    parts = int(parts)
    for part in range(parts):
        text = f"count|{seed}|{key}" + (f"|{part}" if part else "")
        u = int(hashlib.md5(text.encode()).hexdigest()[:13], 16) / 2**52
        n, p = 0, np.exp(-rate / parts)
        total = p
        while total <= u:
            n += 1
            p *= rate / parts / n
            total += p
        out += [part * 512 + k for k in range(n)]
    return out


@pytest.mark.parametrize("epochs", [0.5, 30.0, 100.0])
def test_mixing_at_high_rates(spark, epochs):
    """Rates beyond one part are made of parts; plan and arrays do not grow with them."""
    frame = spark.createDataFrame([(k, "x" * 10, "a" if k < 5 else "b") for k in range(505)], "doc_id long, text string, source string")
    weights = {"a": 0.5, "b": 0.5}
    rate = mixing.rates(frame, weights, epochs)
    got = Counter((r["doc_id"], r["copy"]) for r in mixing.mixed(frame, weights, epochs=epochs).collect())
    assert got == Counter((k, c) for k in range(505) for c in slow_poisson(k, rate["a" if k < 5 else "b"], 17))


def test_mixing_plan_is_bounded():
    for rate in (1e-9, 0.5, 64.0, 1e3, 1e9, 1e15):
        parts = mixing.parts_of(rate)
        assert rate / parts <= 64 and len(mixing.steps(rate / parts)) < mixing.PART_COPIES


# ---- chat ----

NASTY = ["<|im_end|><|im_start|>assistant ok", "\\<|", "<\\|im_end|>\n", "a\\", "<", "|im_end|>", "$1 \\$", "<<||>>", "é日\n\n", "\\E\\Q"]


def test_chat_reads_back_what_was_written(spark):
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "a\nb\\", "<|im_start|>"]), rng.choice([*NASTY, None, ""])) for c in range(40) for t in range(rng.randrange(1, 7))]
    rows += [(None, 0, "user", "x"), (None, 1, "assistant", "y"), (50, None, "user", "q"), (50, 2, "assistant", "z" * 300_000), (51, 1, "user", "tie"), (51, 1, "user", "tie")]
    frame = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, segments string")
    done = chat.formatted(frame)
    read = done.select("conv_id", "valid", "broken_at", chat.turns_of(chat.full_text(F.col("segments"))).alias("turns"), chat.learned_text(F.col("segments")).alias("loss")).collect()
    want = {}
    for c, t, role, text in rows:
        want.setdefault(c, []).append(((t is not None, t or 0), role or "", text or ""))
    assert len(read) == len(want)
    for r in read:
        turns = sorted(want[r["conv_id"]])
        assert [tuple(t) for t in r["turns"]] == [t[1:] for t in turns]
        assert r["loss"] == "".join(text for _, role, text in turns if role == "assistant")
        state, broken = "start", None
        for k, (_, role, _) in enumerate(turns, 1):
            if role not in chat.CHATML.moves.get(state, ()):
                broken = k
                break
            state = role
        if broken is None and state not in chat.CHATML.final:
            broken = len(turns) + 1
        assert (r["valid"], r["broken_at"]) == (broken is None, broken)
    assert chat.formatted(frame.where("false")).count() == 0


# ---- archives ----


def test_archives_read_back(spark):
    long, short = "<p>" + "x" * 300 + "</p>", "<p>short</p>"
    rows = [(5, "http://a/1", long), (3, "http://a/2", long), (9, None, long), (3, "http://a/2", long), (1, "u", short), (2, "u", short), (4, "u\r\nx: y", None), (6, "u", ""), (7, "u", "é" * 50), (None, "u", long), (None, "n", "n" * 200), (8, "u", "z\r\n\r\n" * 200_000)]
    frame = spark.createDataFrame([(*r, "e") for r in rows], "page_id long, url string, html string, digest string").repartition(3)
    path = new_path(spark, "archive-test")
    warc.write_archives(frame, path)
    got = [tuple(r) for r in warc.read_archives(spark, path).drop("url").collect()]
    want = []
    for page_id, _, text in rows:
        raw = (text or "").encode()
        first = min((i for i, _, t in rows if (t or "") == (text or "") and i is not None), default=None)
        again = len(raw) >= 100 and first is not None and first != page_id
        want.append((page_id, "revisit" if again else "response", first if again else None, hashlib.sha256(raw).hexdigest(), len(raw), None if again else raw))
    assert Counter((*g[:5], g[5] if g[5] is None else bytes(g[5])) for g in got) == Counter(want)
    assert warc.archived(frame.where("false")).count() == 0


def test_archives_open_with_the_library_alone():
    records = [warc.record(k, "u", f"<p>page {k % 7} of some site {k}</p>".encode() * 20, "d", None) for k in range(400)]
    data = bytes(warc.EMPTY_FRAME, "latin1").join(warc.frames(iter(records)))
    assert data[:4] == warc.DICTIONARY_MAGIC
    size = int.from_bytes(data[4:8], "little")
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size])).stream_reader(data[8 + size :], read_across_frames=True)
    text = reader.read()
    assert all(r in text for r in records[::37]) and list(warc.unpacked(data))[1:] == records


# ---- pages ----

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p>";</script></head><body>
<div id="top"><a href="/">Home</a> | <a href="/about">About us</a></div>{cookie}<div class="layout"><div class="col">{body}</div>
<div class="sidebar"><p>Side {n}</p></div></div><form><label>Mail</label><button>Go</button></form>
<div class="comments"><p>Reader {n} says hi</p></div><footer>&copy; site</footer></body></html>"""


def pages_without_article():
    pages = [PAGE.format(cookie='<div class="cookie-notice">We use cookies</div>' if k % 2 else "", n=k, body="".join(f"<h2>Head {k}</h2><p>Body {k} part {j} &amp; more<br>text&nbsp;&nbsp;here {'long ' * 30}" for j in range(1 + k % 3))) for k in range(8)]
    want = ["\n".join(x for j in range(1 + k % 3) for x in (f"Head {k}", " ".join(f"Body {k} part {j} & more text here {'long ' * 30}".split()))) for k in range(8)]
    return pages, want


def test_pages_of_one_host(spark):
    pages, want = pages_without_article()
    rows = [(k, f"https://Site.example.com:80/p{k}", p) for k, p in enumerate(pages)]
    rows += [(20, None, "<p>no host</p>"), (21, "notaurl", None), (22, "https://x.org/", ""), (23, "https://x.org/a", "plain <b>text</b>"), (24, "https://y.org", "<article>A &lt;b&gt;<p>B<ul><li>1<li>2</ul><nav>N</nav><aside>S</aside><!-- c --><p hidden>h</article><p>out"), (0, "https://site.example.com/p0", pages[0]), (25, "https://y.org", "<p " + "a='" * 2000 + ">t" + "<" * 5000)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    got = {}
    for r in html.main_text(frame).collect():
        got.setdefault(r["page_id"], []).append(r["text"])
        assert r["n_chars"] == len(r["text"])
    for k, text in enumerate(want):
        assert set(got[k]) == {text}
    assert len(got[0]) == 2 and got[20] == ["no host"] and got[21] == [""] and got[22] == [""] and got[23] == ["plain text"]
    assert got[24] == ["A <b>\nB\n1\n2"]
    assert html.main_text(frame.where("false")).count() == 0


def test_given_pages(spark):
    """In these pages the article is a heading and paragraphs, found by string search."""
    import html as references
    import re

    sources = {r["page_id"]: r["html"] for r in table(spark, SF, "pages").collect()}
    for r in queries.op1_html_extraction(spark, SF).collect():
        body = sources[r["page_id"]].split("<article>")[1].split("</article>")[0]
        parts = re.split(r"</?(?:h1|p)>", body)
        blocks = [" ".join(references.unescape(re.sub(r"</?b>|<br>", "", p)).split()) for p in parts]
        assert r["text"] == "\n".join(b for b in blocks if b)


# ---- pipeline ----


def test_every_stage_by_brute_force(spark):
    docs = table(spark, SF, "documents")
    for k, (name, step) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        after = step(spark, docs, SF).cache()
        rows = after.collect()
        if name == "quality_rules":
            kept = [slow_verdict(r["text"], r["lang"], slow_fertility(r["text"]), slow_rules(r["text"])[5]) for r in before]
            assert Counter(map(tuple, rows)) == Counter(tuple(r) for r, ok in zip(before, kept) if ok)
        elif name == "language_id":
            fitted = language.fit(docs, fold(F.col("doc_id")) != 0)
            sums, letters = language.log_scores([r["text"] for r in before], fitted)
            keep = [n > 0 and slow_usual(row, n, fitted) for row, n in zip(sums, letters)]
            assert Counter(map(tuple, rows)) == Counter(tuple(r) for r, ok in zip(before, keep) if ok)
        elif name == "near_duplicates":
            ids, _ = slow_ids(before)
            assert Counter(map(tuple, rows)) == Counter(tuple(r) for r in before if r["doc_id"] in ids)
            assert len(rows) < len(before)
        elif name == "mixing":
            counts = slow_counts(before)
            assert Counter(map(tuple, rows)) == Counter(t for r in before for t in [tuple(r)] * counts[r["doc_id"]])
        else:
            want = [(r["doc_id"], r["source"], library(r["text"])[0]) for r in before]
            assert Counter((r["doc_id"], r["source"], tuple(r["ids"])) for r in rows) == Counter((*w[:2], tuple(w[2])) for w in want)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == list(corpus_pipeline.COLUMNS)
        docs = after
    assert queries.pipeline(spark, SF).count() == len(rows)


def slow_usual(sums, letters, model):
    """The band of the best language, written out."""
    best = max(range(len(model.langs)), key=lambda k: (sums[k], -k))
    middle, spread = model.usual[best]
    return (sums[best] - model.prior[best]) / letters >= middle - 6 * spread * (1 + 400 / letters) ** 0.5


def slow_counts(rows):
    """Poisson counts by adding up probabilities one by one."""
    weights, chars = corpus_pipeline.WEIGHTS, Counter()
    group = lambda s: s if s in weights else None
    for r in rows:
        chars[group(r["source"])] += len(r["text"] or "")
    wanted = {g: w for g, w in weights.items() if chars[g]}
    out = {}
    for r in rows:
        g = group(r["source"])
        rate = sum(chars.values()) * wanted[g] / sum(wanted.values()) / chars[g]
        u = int(hashlib.md5(f"count|{corpus_pipeline.SEED}|{r['doc_id']}".encode()).hexdigest()[:13], 16) / 2**52
        n, p = 0, np.exp(-rate)
        total = p
        while total <= u:
            n += 1
            p *= rate / n
            total += p
        out[r["doc_id"]] = n
    return out


"""Main text of pages, automata, held-out accuracy, and the laws of shards and mixes."""

import html
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortix.llm import html_extract, langid, mixing, quality, queries, sharding, spotsigs
from cohortix.llm.html_extract import extract

from .conftest import SF

PROSE = "A paragraph of the article that is long enough to be text, with a comma and &amp; a sign. "


def test_article_between_boilerplate():
    page = f"""<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>if (a<b) x("</p>")</script></head>
    <body class="has-sidebar"><header>Site</header><nav><ul><li><a href=1>Home</a><li><a href=2>More</a></ul></nav>
    <div class="cookie-notice">We use cookies. {PROSE * 3}</div><div id=sidebar><p>{PROSE * 3}</div>
    <h1>Title</h1><p>{PROSE}\n  <b>bold</b>&nbsp;end<p>{PROSE * 2}<br>more</p><aside>{PROSE}</aside>
    <ul><li>one</li><li>two &lt;3</li></ul><form><input value=x><label>Name</label></form><p>{PROSE}</p>
    <!-- {PROSE} --><section class="comments"><p>{PROSE * 3}</p></section><footer>&copy; x</footer></body></html>"""
    p = html.unescape(PROSE).strip()
    assert extract(page).split("\n\n") == ["Title", f"{p} bold end", f"{p} {p} more", "one", "two <3", p]


@pytest.mark.parametrize("tag", ["article", "main", 'div class="content"'])
def test_same_text_with_and_without_article_tags(tag):
    body = f"<h1>T</h1><p>{PROSE * 2}</p><p>{PROSE}</p>"
    page = f"<nav><a href=x>menu</a></nav><{tag}>{body}</{tag.split()[0]}><footer>f</footer>"
    assert extract(page).count("\n\n") == 2 and extract(page).startswith("T\n\n")


LINKS = [f"Reference number {i} in a list" for i in range(6)]


@pytest.mark.parametrize("tag", ["article", "main"])
def test_linked_blocks_in_an_article_are_text(tag):
    p = html.unescape(PROSE).strip()
    refs = "".join(f"<li><a href=r>{x}</a></li>" for x in LINKS)
    page = f"""<nav><a href=x>menu</a></nav><ul><li><a href=o>outside</a></ul><{tag}><h1><a href=t>Linked title</a></h1>
    <p>{PROSE}</p><ul>{refs}</ul><p><a href=e>All of it a link</a></p><p>{PROSE}</p><ol>{refs}</ol>
    <div class="related"><a href=b>beside</a></div><p><a href=z>Last link</a></p></{tag}><ul><li><a href=o>out</a></ul>"""
    assert extract(page).split("\n\n") == ["Linked title", p, *LINKS, "All of it a link", p, *LINKS, "Last link"]


def test_an_article_of_links_only():
    assert extract("<article><h1><a href=t>Links</a></h1><p><a href=u>One</a></p></article>") == "Links\n\nOne"


def test_linked_headline_and_blocks_without_an_article_element():
    p = html.unescape(PROSE).strip()
    page = f"""<ul><li><a href=1>Home</a><li><a href=2>More</a><li><a href=3>Still more</a></ul><div><h1><a href=t>Title</a></h1>
    <div><a href=b>By someone</a></div><p>{PROSE * 2}</p><p>See <a href=l>a link that is most of its block</a></p>
    <h2><a href=h>Linked section</a></h2><p>{PROSE}</p></div><ul><li><a href=4>About</a><li><a href=5>Terms</a><li>
    <a href=6>Contact</a></ul>"""
    assert extract(page).split("\n\n") == [
        "Title", "By someone", f"{p} {p}", "See a link that is most of its block", "Linked section", p]


def by_hand(rows, window=3, surge=80):
    """The line-block rule of a page without an article element, by loops over every window."""
    n = len(rows)
    size = [r[1] for r in rows]
    total = [sum(size[k] for k in range(i, min(n, i + window))) for i in range(n)]
    runs, i = [], 0
    while i < n:
        if size[i] == 0:
            i += 1
            continue
        j = i
        while j < n and total[j] > 0:
            j += 1
        first = i
        for k in range(i - 1, max(runs[-1][1] if runs else 0, i - window + 1) - 1, -1):
            if rows[k][3] and rows[k][0]:
                first = k
        runs.append((first, j, max(total[i:j]), sum(size[first:j])))
        i = j
    high = [r for r in runs if r[2] >= surge]
    if not high and runs:
        most = max(r[3] for r in runs)
        high = [next(r for r in runs if r[3] == most)]
    return [rows[k][0] for r in high for k in range(r[0], r[1]) if rows[k][0]]


def test_line_blocks_equal_a_plain_loop():
    rng = random.Random(12)
    for _ in range(400):
        parts = []
        for _ in range(rng.randint(0, 25)):
            words = "word " * rng.choice([1, 2, 5, 20])
            parts.append(rng.choice([
                f"<p>{words}</p>", f"<div>{words}</div>", f"<p><a href=x>{words}</a></p>", "<p></p>", "<nav>menu</nav>",
                f"<h2><a href=y>{words}</a></h2>", f"<h3>{words}</h3>", f"<li>{words}<a>{words}</a></li>",
                '<div class="ad">buy</div>', "<br>", "<hr>", f"{words}"]))
        page = "".join(parts)
        assert html_extract.main_blocks(page) == by_hand(list(html_extract.lines(page)))


def test_broken_markup_takes_linear_time():
    import time

    for bad in ("<b>x</i>", "<b><div>x</div>", "<p><b>x</p>", "<a<", "</div></b>", "<a 'x", "<li><b>y</p>"):
        page = bad * (1_000_000 // len(bad))
        t = time.perf_counter()
        list(html_extract.lines(page))
        took = time.perf_counter() - t
        assert took < 5, (bad, took)


def test_pages_hold_their_article(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in queries.op5_line_blocks(spark, SF).collect():
        inner = re.search("<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", "", b.replace("<br>", " "))).split())
                  for b in re.split("</?(?:p|h1)>", inner)]
        assert r["text"] == "\n\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_automaton_takes_exactly_the_substrings():
    rng = np.random.default_rng(1)
    s = rng.integers(0, 3, 60)
    n, state, code, to = langid.suffix_automaton(s)
    table = np.zeros((n, 3), int)
    table[state, code] = to
    known = {tuple(s[i:j]) for i in range(60) for j in range(i + 1, 61)}
    for n in range(1, 7):
        for x in rng.integers(0, 3, (100, n)):
            state = 1
            for c in x:
                state = table[state, c] if state else 0
            assert (state > 0) == (tuple(x) in known)


@pytest.mark.parametrize("dense", [langid.DENSE, 0])
def test_phrases_match_greedy_parsing(monkeypatch, dense):
    monkeypatch.setattr(langid, "PIECE", 16)
    monkeypatch.setattr(langid, "DENSE", dense)
    rng = random.Random(2)
    make = lambda a, n: "".join(rng.choice(a) for _ in range(n))
    train = [("a", make("abc ", 90)), ("b", make("bcd ", 90))]
    parser = langid.Parser(train)
    texts = [langid.normal(make("abcde ", n)) for n in (0, 1, 15, 16, 17, 100)]
    got = parser.phrases(texts)
    held = [langid.normal(t) for _, t in train]
    for i, t in enumerate(texts):
        for k, src in enumerate(held):
            n = 0
            for p in range(0, len(t), 16):
                piece, at = t[p:p + 16], 0
                while at < len(piece):
                    end = at + 1
                    while end < len(piece) and piece[at:end + 1] in src:
                        end += 1
                    n, at = n + 1, end
            assert got[i, k] == n


def test_large_alphabets_and_many_languages():
    """3,000 signs and 50 languages: the automata stay far below 300 MB, and the right one wins."""
    rng = random.Random(9)
    signs = [chr(0x4E00 + i) for i in range(3000)]
    train = [("zh", " ".join("".join(rng.choice(signs) for _ in range(7)) for _ in range(5000)))]
    alphabet = "abcdefghijklmnopqrstuvwxyzäöüßéèñçøåæ"
    for k in range(49):
        own = rng.sample(alphabet, 14)
        train.append((f"l{k:02d}", " ".join("".join(rng.choice(own) for _ in range(6)) for _ in range(1500))))
    parser = langid.Parser(train)
    assert isinstance(parser.moves, langid.Hashed)
    assert sum(x.nbytes for x in (parser.moves.state, parser.moves.code, parser.moves.to)) < 150e6
    for lang, text in train[:6]:
        assert parser.predict([text[100:400]])[0][0] == lang


def test_cut_texts_hold_the_shares(spark):
    rng = random.Random(3)
    for lens in ([5, 5, 5], [100, 2, 40, 7, 60], [50] * 9, [1000], [0, 3, 1000, 1000], list(range(60))):
        texts = ["".join(rng.choice("abc") for _ in range(n)) for n in lens]
        df = spark.createDataFrame([("x", i / 100, t) for i, t in enumerate(texts)], "lang string, rank double, text string")
        cut = {r["rank"]: r["text"] for r in langid.cut_to_shares(df, 101).collect()}
        got = [cut[i / 100] for i in range(len(texts))]
        one, two = langid.shares(got, 101), langid.shares(texts, 101)  # a letter of the rest may go to another text
        assert sum(map(len, one)) == sum(map(len, two)) and all(abs(len(a) - len(b)) <= 1 for a, b in zip(one, two))
        assert sum(map(len, got)) <= 101 + 2 * len(got)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    x = queries.op9_cross_parsing(spark, sf).join(docs, "doc_id").where("held_out and lang is not null")
    right, every = x.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert every > 100 and right / every > 0.97
    assert x.where("score < 0 or score > 1").count() == 0


def test_copies_do_not_thin_the_training_sample(spark):
    # 1,000 different texts among ten million rows of copies of one of them
    few = spark.range(1000).selectExpr("'xx' AS lang", "concat('text number ', id) AS text")
    copies = spark.range(9_999_000).selectExpr("'xx' AS lang", "'text number 7' AS text")
    got = [r["text"] for r in langid.training_texts(few.unionByName(copies), F.lit(True)).collect()]
    assert 150 <= len(got) == len(set(got)) <= 250


def test_every_picked_text_has_a_share(spark, monkeypatch):
    # a long text of digits, one of one letter and 20 others: all are in the training text of their language
    texts = ["0" * 100_000 + " hidden", "a" * 100_000] + [f"z{c * 3000}" for c in "bcdefghijklmnopqrstu"]
    df = spark.createDataFrame([(i, "xx", t) for i, t in enumerate(texts)], "doc_id long, lang string, text string")
    made = []
    monkeypatch.setattr(spark.sparkContext, "broadcast", lambda x: made.extend(x))
    langid.predict_languages(df, F.lit(True))
    got = [t for _, t in made]
    assert len(got) == 22 and "hidden" in got
    assert all(len(t) > 1500 for t in got if t != "hidden")
    assert 39_900 <= len(" ".join(got)) <= langid.TRAIN_CHARS


def test_shares_use_the_whole_budget():
    assert langid.shares(["aaaa", "b", "cccccc"], 9) == ["aaa", "b", "ccc"]
    assert langid.shares(["aa", "b"], 9) == ["aa", "b"] and langid.shares([]) == []


def test_shards_keep_their_law(docs):
    n = docs.count()
    x = sharding.interleave(docs, 7)
    per = x.groupBy("shard").agg(F.count("*").alias("n"), F.min("slot").alias("lo"), F.max("slot").alias("hi"),
                                 F.count_distinct("slot").alias("slots")).collect()
    assert sum(r["n"] for r in per) == n and max(r["n"] for r in per) - min(r["n"] for r in per) <= 1
    assert all(r["lo"] == 0 and r["hi"] == r["n"] - 1 == r["slots"] - 1 for r in per)
    # the mixture: each source within two rows of its share in every shard
    src = {r["source"]: r["count"] for r in x.groupBy("source").count().collect()}
    for r in x.groupBy("shard", "source").count().collect():
        assert abs(r["count"] - src[r["source"]] / 7) <= 2


def test_seats_are_sainte_lague(spark):
    rng = random.Random(3)
    sizes = [rng.randint(0, 5000) for _ in range(40)]
    rows = [(False, f"s{i:02d}", i, n, rng.choice([2.0, 2 * rng.random()]) * n) for i, n in enumerate(sizes)]
    t = spark.createDataFrame(rows, "_none boolean, _src string, _i long, source_size long, target double")
    block, shards = 16, 5
    got = {}
    for r in mixing.apportion(t, block, shards).collect():
        got.setdefault(r["shard"], {})[r["_src"]] = r["quota"]
    cap = {r[1]: 2 * math.ceil(r[3] / block) for r in rows}
    quotients = sorted(((-r[4] / (2 * k + 1), r[2], r[1]) for r in rows if r[4] > 0 for k in range(cap[r[1]])))
    total = sum(r[4] for r in rows)
    before = 0
    for j in range(shards):
        end = math.floor(total / block * (j + 1) / shards + 0.5)
        want = {}
        for _, _, s in quotients[before:end]:
            want[s] = want.get(s, 0) + 1
        assert {s: q for s, q in got[j].items() if q} == want
        before = min(end, len(quotients))


def test_mix_comes_near_its_targets(docs):
    x, quotas = mixing.mix(docs)
    rows = x.groupBy("source").agg(F.max("target").alias("t"), F.sum("taken").alias("k")).collect()
    assert all(abs(r["t"] - r["k"]) <= 2 * 64 for r in rows)
    assert x.where("taken > 2 * size or taken < 0").count() == 0
    assert sorted(x.collect()) == sorted(mixing.mix(docs)[0].collect())
    per = [r["sum(quota)"] for r in quotas.groupBy("shard").sum("quota").collect()]
    assert max(per) - min(per) <= 1


def test_every_shard_takes_the_words_of_its_seats(docs):
    """By a loop over all seats of a source: block after block of its stream, shard after shard."""
    x, quotas = mixing.mix(docs, block=16, n_shards=5)
    rows = x.collect()
    seats = {}
    for r in sorted(quotas.collect(), key=lambda r: r["first_seat"]):
        seats.setdefault(r["source"], []).extend([r["shard"]] * r["quota"])
    got = {}
    for r in rows:
        assert sum(c["words"] for c in r["by_shard"]) == r["taken"] <= 2 * r["size"]
        for c in r["by_shard"]:
            got[r["source"], c["shard"]] = got.get((r["source"], c["shard"]), 0) + c["words"]
    assert any(len(r["by_shard"]) > 1 for r in rows)
    for source, shards in seats.items():
        mine = [r for r in rows if r["source"] == source]
        n = sum(r["size"] for r in mine)
        blocks = -(-n // 16)
        short = 16 * blocks - n  # the last block may be shorter
        for j in set(shards):
            k = shards.count(j)
            assert 16 * k - short * -(-k // blocks) <= got[source, j] <= 16 * k


def test_rows_without_ids_spread_over_buckets(spark, monkeypatch):
    """A third of the rows have no id: their order takes the text, so no bucket holds them all."""
    from cohortix.llm import common

    monkeypatch.setattr(sharding, "size_buckets", lambda n: 20)
    made = []
    real = common.hash_bucket
    monkeypatch.setattr(sharding, "hash_bucket", lambda h, n: made.append(real(h, n)) or made[-1])
    df = spark.range(3000).selectExpr("if(id % 3 = 0, null, id) doc_id", "concat('text ', id) text", "'s' source")
    out = sharding.interleave(df, 4)
    assert out.count() == 3000 and out.groupBy("shard").count().where("count = 750").count() == 4
    h = common.unit_hash(F.lit(42), F.col("doc_id"), F.md5("text"))
    per = [r["count"] for r in df.groupBy(real(h, 20).alias("b")).count().collect()]
    assert len(per) == 20 and max(per) < 250 and made


def test_repeated_windows_match_brute_force(spark):
    rng = random.Random(4)
    texts = ["", "a b", "w " * 30] + [" ".join(rng.choice("ab") for _ in range(rng.randint(5, 200))) for _ in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality.text_counts(df).collect():
        w = texts[r["doc_id"]].split()
        seen = {}
        for i in range(len(w) - 7):
            seen.setdefault(tuple(w[i:i + 8]), []).append(i)
        want = {p + k for ps in seen.values() if len(ps) > 1 for p in ps for k in range(8)}
        assert r["n_repeat_words"] == len(want) and r["n_words"] == len(w)


def test_binomial_bound(spark):
    cases = [(0, 10), (0, 3000), (5, 1000), (9, 1000), (10, 1000), (900, 100_000), (9800, 1_000_000)]
    df = spark.createDataFrame(cases, "k long, n long").withColumn(
        "p", quality.binomial_cdf(F.col("k"), F.col("n"), 0.01))
    for r in df.collect():
        k, n = r["k"], r["n"]
        want = 1.0 if k >= 0.01 * n else math.fsum(math.exp(
            math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(0.01)
            + (n - i) * math.log(0.99)) for i in range(k + 1))
        assert r["p"] == pytest.approx(want, rel=1e-6)


def test_cutoffs_bound_the_false_rejections(spark):
    good = [(i, "clean words " + " ".join(f"w{i}x{j}" for j in range(30)), "en") for i in range(900)]
    noisy = [(2000 + i, " ".join(f"w{j}##" for j in range(40)), "en") for i in range(50)]
    rare = [(3000 + i, " ".join(f"w{j}##" for j in range(40)), "xx") for i in range(50)]
    df = spark.createDataFrame(good + noisy + rare, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(900)] + [(3000 + i, 1) for i in range(20)],
                                   "doc_id long, quality int")
    out = {r["doc_id"]: r["kept"] for r in quality.quality_verdicts(df, labels).collect()}
    assert all(out[i] for i in range(900)) and not any(out[2000 + i] for i in range(50))
    assert all(out[3000 + i] for i in range(50))  # too few labels to reject anything there


def test_the_joint_verdict_is_certified(spark):
    """Three rules that each reject another 0.8 % of the good documents: together at most 1 % may go."""
    def words(i, n=40):
        return [f"w{i}x{j}" for j in range(n)]

    rows = []
    for i in range(6000):
        w = words(i)
        if i % 125 == 0:
            t = " ".join(w) + "#" * 200
        elif i % 125 == 1:
            t = "\n".join([" ".join(w[:12])] * 4 + [" ".join(w[12:])])
        elif i % 125 == 2:
            t = " ".join(w[:8] + w + w[:8])
        else:
            t = " ".join(w)
        rows.append((i, t, "en"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    labels = df.selectExpr("doc_id", "1 quality")
    counts, _ = quality.cutoffs(df, labels)
    cut = quality.certified_cutoffs(counts, labels, "stratum").collect()
    assert len(cut) == 1 and cut[0]["p_value"] <= 0.05
    out = quality.quality_verdicts(df, labels).collect()
    gone = sum(not r["kept"] and not r["base_failed"] for r in out)
    assert 0 < gone <= 60 and gone == cut[0]["n_rejected"]
    steps = quality.tightenings()
    assert steps[0] == {"symbols": 0.5, "dup_lines": None, "repeats": None} and len(steps) == 20
    assert steps[-1] == {r: c[0] for r, c in quality.CUTOFFS.items()}


def test_next_document_over_all_buckets(spark, monkeypatch):
    monkeypatch.setattr(spotsigs, "size_buckets", lambda n: max(1, n // 3))
    ids = [*range(0, 40), 10 ** 15, 10 ** 15 + 1, -5, 2 ** 62]
    rng = random.Random(8)
    rows = [(i, f"text of {i} and the tail " * rng.randint(1, 3)) for i in ids]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    order = sorted(rows)
    nxt = {a[0]: b[1] for a, b in zip(order, order[1:] + order[:1])}
    text = dict(rows)
    got = spotsigs.fingerprints(df).collect()
    assert len(got) == len(rows)
    sigs = {r["doc_id"]: r["sigs"] for r in got}
    after = {a[0]: b[0] for a, b in zip(order, order[1:] + order[:1])}
    for r in got:
        t, k = text[r["doc_id"]], len(text[r["doc_id"]]) // 4
        assert r["edited"] == t[:len(t) - k] + nxt[r["doc_id"]][:k]
        assert r["next_sigs"] == sigs[after[r["doc_id"]]]

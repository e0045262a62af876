"""The operators against their plain versions, on small tables made to hold the hard cases."""

from __future__ import annotations

import hashlib
import html
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from tertulia.llm import chat, decontaminate, html_text, licenses, line_dedup, mixing, near_dup, quality, substring, toxicity
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, size int, rep long"


def corpus(seed=3, n=120):
    """Documents with copies, near copies, shared passages, empty, null and long texts."""
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(900)] + ["Straße", "ÉTÉ", "a,b"]
    base = [r.choice(vocabulary) for _ in range(140)]
    passage = [r.choice(vocabulary) for _ in range(70)]
    texts = [None, "", "  \n ", "one", "One", "one two", " ".join(base), " ".join(base).upper(), "x " * 300]
    for _ in range(25):  # near copies at many similarities
        copy = list(base)
        for _ in range(r.randint(1, 14)):
            copy[r.randrange(len(copy))] = r.choice(vocabulary)
        texts.append("\n".join(" ".join(copy[k: k + 20]) for k in range(0, len(copy), 20)))
    for _ in range(25):
        own = [r.choice(vocabulary) for _ in range(r.randint(5, 90))]
        cut = r.randint(0, len(own))
        texts.append(" ".join(own[:cut] + passage[r.randint(0, 12):] + own[cut:]))
    texts += [r.choice(texts[6:]) for _ in range(15)]
    texts += [" ".join(r.choice(vocabulary) for _ in range(r.randint(1, 200))) for _ in range(n - len(texts) - 1)]
    texts.append(" ".join(r.choice(vocabulary) for _ in range(20_000)))
    ids = r.sample(range(1000), len(texts))
    return list(zip(ids, texts))


def frame(spark, docs, source="s"):
    return spark.createDataFrame([(d, t, "en", source, len(t or ""), "k", 1, 7) for d, t in docs], SCHEMA)


def rows(df, n):
    return {r[0]: tuple(r)[1: 1 + n] for r in df.collect()}


@pytest.fixture(scope="module")
def docs():
    return corpus()


def test_substring_dedup(spark, docs):
    assert rows(substring.op1(frame(spark, docs)), 3) == brute.op1(docs)


def test_repeats_are_maximal_and_gone(spark):
    shared = " ".join(f"p{k}" for k in range(60))
    out = substring.without_repeats(frame(spark, [(1, f"a b {shared} c"), (2, f"d {shared} e f")])).collect()
    got = {r["doc_id"]: (r["text"], r["repeats"]) for r in out}
    assert got == {1: (f"a b {shared} c", []), 2: ("d e f", [[1, 61]])}


def test_near_duplicates(spark, docs):
    assert rows(near_dup.op3(frame(spark, docs)), 3) == brute.op3(docs)


def test_near_duplicates_when_every_group_is_large(spark, docs, monkeypatch):
    """Buckets are dealt anew, by shingles outside their centers, until nothing is left."""
    monkeypatch.setattr(near_dup, "SMALL", 2)
    assert rows(near_dup.op3(frame(spark, docs)), 3) == brute.op3(docs)


def test_near_duplicate_stage_keeps_one_row_and_all_columns(spark, docs):
    kept = near_dup.one_of_each(frame(spark, docs))
    assert kept.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    assert {r.doc_id for r in kept.collect()} == {d for d, (_, _, k) in brute.op3(docs).items() if k}


def test_signatures_find_every_pair_at_the_threshold(spark):
    """200 pairs of a similarity just over 0.75 all meet in a bucket."""
    r, pairs = random.Random(5), []
    for k in range(200):
        words = [f"{k}x{j}" for j in range(104)]
        other = list(words)
        for at in r.sample(range(0, 100, 10), 2):
            other[at + 4] = f"{k}y{at}"
        pairs += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
    got = rows(near_dup.op3(frame(spark, pairs)), 3)
    assert got == brute.op3(pairs)
    assert sum(not kept for *_, kept in got.values()) == 200


def test_benchmark_search(spark, docs):
    items = [(k, " ".join((t or "").split()[3: 3 + n])) for k, (n, (_, t)) in enumerate(zip([0, 1, 4, 10, 30, 60] * 8, docs[5:]))]
    items += [(100, None), (101, "W1 w2"), (102, "w1, W2")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = brute.op7(docs, items)
    assert rows(decontaminate.op7(frame(spark, docs), bench), 5) == expected
    in_blocks = decontaminate.benchmark_hits(frame(spark, docs), bench, block=40)
    got = {r.doc_id: (sum(h.end - h.first for h in r.hits), r["items"]) for r in in_blocks.collect()}
    assert {d: (g[0], len(g[1])) for d, g in got.items()} == {d: (x[1], x[2]) for d, x in expected.items()}


def test_quality_measures_and_passing(spark, docs):
    got = {r.doc_id: r for r in quality.op6(frame(spark, docs)).collect()}
    for doc, text in docs:
        w, t = brute.words(text), text or ""
        runs = [tuple(w[k: k + 5]) for k in range(len(w) - 4)]
        inside = {j for k, x in enumerate(runs) if runs.count(x) > 1 for j in range(k, k + 5)} if len(w) < 1000 else set()
        lines = [x for x in t.split("\n") if brute.words(x)]
        expected = (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside))
        assert tuple(got[doc])[1:6] == expected, doc
        assert got[doc].base_failed == (len(w) < 10 or 100 * len(inside) > 20 * len(w))
    kept = quality.passing(frame(spark, docs))
    assert {r.doc_id for r in kept.collect()} == {d for d, r in got.items() if r.kept}


def test_quality_distance(spark):
    import math
    p, q = [3, 1, 0], [1, 1, 2]
    a, b = [x / 4 for x in p], [x / 4 for x in q]
    m = [(x + y) / 2 for x, y in zip(a, b)]
    expected = math.sqrt(sum(x * math.log2(x / z) for x, z in zip(a, m) if x) / 2 + sum(y * math.log2(y / z) for y, z in zip(b, m) if y) / 2)
    df = spark.createDataFrame([(p,)], "c array<long>").select(quality.js_distance("c", F.lit(4.0), q).alias("d"))
    assert df.first()[0] == pytest.approx(expected)


def test_line_dedup(spark):
    made = [(k, f"own {k}\nMenu \nRead more" if k < 8 else f"own {k}\n\nsame", "a" if k < 20 else None) for k in range(40)]
    made += [(50, None, "a"), (51, "", "a")]
    df = spark.createDataFrame(made, "doc_id long, text string, source string").withColumn("n_chars", F.lit(9))
    kept = {r.doc_id: r.text for r in line_dedup.without_boilerplate(df).collect()}
    assert len(kept) == len(made)
    for doc, text, _ in made:
        expected = text if not text else "\n".join(x for x in text.split("\n") if x.strip() not in {"Menu", "Read more", "same"})
        assert kept[doc] == expected


def test_toxicity_learns_and_is_folded(spark):
    made = [(k, ("plain words here " * 5) + ("you are a zorkel today" if k % 4 == 0 else "fine day")) for k in range(400)]
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(400)], "doc_id long, toxic int")
    df = frame(spark, made)
    got = {r.doc_id: r.predicted for r in toxicity.op5(df, labels).collect()}
    assert all(got[k] == int(k % 4 == 0) for k in range(400))
    model = toxicity.fitted(df, labels)
    odd = frame(spark, [(1, "you are a z0rk3l today"), (2, "you are a zоrkеl today"), (3, "take out the trash"), (4, None), (5, "")])
    scores = {r.doc_id: r.score for r in toxicity.scored(odd, model).collect()}
    assert min(scores[1], scores[2]) > 0.5 > max(scores[3], scores[4], scores[5])
    assert toxicity.fold("1d1ot tr@sh 2024 a1 i.e. 100") == "idiot trash 2024 ai i.e. 100"


def test_toxicity_without_labels_has_no_lexicon(spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    got = rows(toxicity.op5(frame(spark, [(1, "you idiot"), (2, None)]), labels), 3)
    assert got[1] == got[2] and got[1][2] == 0


def test_toxicity_scores_are_those_of_a_plain_count(spark):
    """Scores by a plain search for the words of the learned lexicon, without the automaton."""
    r = random.Random(6)
    plain, bad = [f"good{k}" for k in range(40)], ["zorkel", "vantrix", "plo", "class", "clown"]
    made = [(k, " ".join(r.choice(plain + bad * (k % 3 == 0)) for _ in range(r.randint(0, 40))) + " class clown" * (k % 27 == 1)) for k in range(300)]
    df, labels = frame(spark, made), spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(300)], "doc_id long, toxic int")
    model = toxicity.fitted(df, labels)
    assert {"zorkel", "vantrix", "plo"} < set(model.weights) and {"class", "clown"} & set(model.weights) and model.left_out == 0
    for doc, score in rows(toxicity.scored(df, model), 1).items():
        words = made[doc][1].split(" ")
        weight = sum(model.weights.get(w, 0) for k, w in enumerate(words)
                     if not (w == "clown" and k and words[k - 1] == "class" or w == "class" and words[k + 1: k + 2] == ["clown"]))
        figures = [math.log1p(weight), weight / math.sqrt(len(words)), float(weight > 0), 1.0]
        assert score[0] == pytest.approx(1 / (1 + math.exp(-sum(a * b for a, b in zip(figures, model.factors)))))
    few = toxicity.fitted(df, labels, terms=2)
    assert len(few.weights) == 2 and few.left_out == len(model.weights) - 2


def test_chat_round_trip(spark):
    r = random.Random(1)
    parts = ["<|im_end|>", "<|", "<\\|", "<\\\\|", "\\", "\n", "%0A", "%25", "é", "a", "<", "|", " "]
    made = [(c, t, r.choice(["user", "assistant", "a\nb", "%0A<|", None]), "".join(r.choices(parts, k=r.randint(0, 12))) or None)
            for c in range(40) for t in range(r.randint(1, 6))]
    df = spark.createDataFrame(made, "conv_id long, turn long, role string, text string")
    out = chat.formatted(df.withColumn("parts", chat.text_parts("text")))
    back = out.select("conv_id", chat.read_back("text").alias("turns"), chat.learned("text", "loss").alias("learned")).collect()
    for row in back:
        turns = [(role or "", text or "") for c, _, role, text in made if c == row.conv_id]
        assert [tuple(t) for t in row.turns] == turns
        assert row.learned == "".join(t for role, t in turns if role == "assistant")


def test_chat_attachments(spark):
    part = "kind string, text string, uri string, width int, height int, seconds double, pages int"
    made = [(1, 0, "user", [("text", "see ", None, None, None, None, None), ("image", None, "u1", 1000, 300, None, None),
                            ("audio", None, "u2", None, None, 2.5, None), ("text", "<|", None, None, None, None, None),
                            ("document", None, "u3", None, None, None, 3), None]), (1, 1, "assistant", None)]
    df = spark.createDataFrame(made, f"conv_id long, turn long, role string, parts array<struct<{part.replace(' ', ':')}>>".replace(",:", ", "))
    row = chat.formatted(df).first()
    assert row.text == "<|im_start|>user\nsee <|image:1|><|audio:2|><\\|<|document:3|><|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
    assert [(a.place, a.kind, a.uri, a.tokens) for a in row.attachments] == [
        (1, "image", "u1", 85 + 170 * 2), (2, "audio", "u2", 63), (3, "document", "u3", 768)]
    assert row.expanded_tokens == 425 + 63 + 768


def test_license_places_and_templates(spark):
    notice = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation FILES"
    made = [(1, "x the MIT License, mit license"), (2, f"intro\n{notice}\nend"), (3, "smit license"), (4, None), (5, "Licensed under CC BY-NC 4.0."), (6, "")]
    got = {r.doc_id: r for r in licenses.op8(frame(spark, made)).collect()}
    assert (got[1].n_base, got[1].first_word, got[1].last_word, got[1].base_labels) == (2, 2, 4, "mit")
    assert (got[2].n_base, got[2].labels, got[2].score) == (0, "mit", 1.0)
    assert (got[3].labels, got[4].n_words, got[6].score) == ("", 0, 0.0)
    assert got[5].base_labels == "cc-by" and got[5].labels == "cc-by,cc-by-nc"


def test_license_join_is_exact(spark):
    """Against all containments, on blocks made from template words."""
    r = random.Random(2)
    vocabulary = sorted({w for _, t in licenses.TEMPLATES for w in t.split()}) + ["other", "words"]
    made = []
    for k in range(150):
        tokens = r.choice(licenses.TEMPLATES)[1].split()
        keep = [w for w in tokens if r.random() < 0.95] + r.choices(vocabulary, k=r.randint(0, 5))
        r.shuffle(keep)
        made.append((k, " ".join(keep)))
    expected = set()
    for doc, text in made:
        for label, template in licenses.TEMPLATES:
            t = set(template.split())
            if len(t & set(text.split())) >= licenses.THRESHOLD * len(t) - 1e-9:
                expected.add((doc, label))
    found = licenses.licenses(frame(spark, made)).select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.label")
    assert {tuple(x) for x in found.collect()} == expected


def _plain_mix(docs, most=3):
    sizes = {d: len(brute.words(t)) for d, t, _ in docs}
    source = {d: s for d, _, s in docs}
    names = sorted({s for s in source.values() if s is not None}, key=lambda s: s.encode()) + ([None] if None in source.values() else [])
    size = {s: sum(sizes[d] for d in sizes if source[d] == s) for s in names}
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(names)}
    target, open_ = {}, set(names)
    while open_:
        share = (sum(size.values()) - sum(target.values())) / sum(weight[s] for s in open_)
        over = {s for s in open_ if share * weight[s] > most * size[s]}
        target |= {s: most * size[s] for s in over} or {s: share * weight[s] for s in open_}
        open_ -= over or open_
    taken = {}
    for s in names:
        at = 0
        for d in sorted((d for d in sizes if source[d] == s), key=lambda d: hashlib.md5(str(d).encode()).hexdigest()):
            taken[d] = sum(max(0, min(sizes[d], round(target[s]) - at - k * size[s])) for k in range(most))
            at += sizes[d]
    return {d: (sizes[d], size[source[d]], target[source[d]], taken[d]) for d in sizes}


def test_mixing(spark):
    r = random.Random(4)
    made = [(k, "w " * r.randint(0, 60), r.choice(["a", "b", "b", "b", "b", "b", "c", "d", None])) for k in range(300)] + [(900, None, "e")]
    df = spark.createDataFrame(made, "doc_id long, text string, source string")
    got = rows(mixing.op9(df), 4)
    for doc, (size, source_size, target, taken) in _plain_mix(made).items():
        assert got[doc] == (size, source_size, pytest.approx(target), taken), doc
    mixed = mixing.mixed(df).collect()
    places, taken = [x.mix_position for x in mixed], {}
    for x in mixed:
        taken[x.doc_id] = taken.get(x.doc_id, 0) + x.mix_taken
    assert places == sorted(places) and taken == {d: x[3] for d, x in got.items() if x[3] > 0}
    assert len({(x.doc_id, x.mix_copy) for x in mixed}) == len(mixed) and max(x.mix_copy for x in mixed) == 2


def test_schedule_is_inverted(spark):
    for knots in mixing.SCHEDULES.values():
        df = spark.range(101).select((F.col("id") / 100).alias("y")).select("y", mixing.due(F.col("y"), knots).alias("t"))
        whole = sum((b - a) * (v + w) / 2 for (a, v), (b, w) in zip(knots, knots[1:]))
        for y, t in df.collect():
            done = sum((min(t, b) - a) * (v + v + (w - v) * (min(t, b) - a) / (b - a)) / 2 for (a, v), (b, w) in zip(knots, knots[1:]) if t > a)
            assert done / whole == pytest.approx(y, abs=1e-9)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h2>Site</h2></header><nav><ul><li><a href="/a">A</a></li></ul></nav><!-- ad --><div class="ad">Buy</div>
<article><h1>Title &amp; more</h1><p><b>Bold.<br><p>First&nbsp;  par
agraph &lt;x&gt;.</p><p>Ok.</p><aside>Side</aside><form><p>Mail</p></form><div class="comments"><p>Nice</p></div></article>
<div id="sidebar">More</div><footer>&copy; us</footer></body></html>"""


def test_html(spark):
    long = "A sentence of the story that goes on for a while. " * 4
    bare = f"<body><div class='menu'>Home</div><div>Hi</div><hr><h1>T</h1><p>{long}</p><p>Ok.</p><div class='footer'>x</div></body>"
    deep = "<div>" * 50_000 + "deep"
    made = [(1, "u", PAGE), (2, "u", None), (3, None, ""), (4, "u", bare), (5, "u", deep), (6, "u", "<![foo[x]]> a < b <p"), (7, "u", "<" * 5000),
            (8, "u", "<p>" + "word " * 200_000)]
    got = {r.page_id: r for r in html_text.op10(spark.createDataFrame(made, "page_id long, url string, html string")).collect()}
    assert got[1].text == "Title & more\nBold.\nFirst par agraph <x>.\nOk."
    assert got[2].text == got[3].text == "" and got[3].n_chars == 0
    assert got[4].text == f"Hi\nT\n{long.strip()}\nOk."
    assert got[5].text == "deep" and got[6].text == "a < b" and got[8].n_chars == 999_999


def test_html_windows_decide_on_every_page():
    long = "A sentence of the story that goes on for a while. " * 4
    teaser = f"<article><p>Teaser of another story.</p></article><div><p>{long}</p><p>Ok.</p></div>"
    assert html_text.main_text(teaser) == f"Teaser of another story.\n{long.strip()}\nOk."
    advert = f"<div><p>{long}</p><div class='ad'><div><div>Buy<p>now</div></div></div><p>Short.</p></div>"
    assert html_text.main_text(advert) == f"{long.strip()}\nShort."
    ended = f"<div>{long}</div><div class='ad'>x</div><div class='related'>y</div><div class='footer'>z</div><div>Top</div>"
    assert html_text.main_text(ended) == long.strip()
    assert html_text.main_text(f"<div>By us</div><article><h1>T</h1><p>Hm.</p><p>So.</p><p>{long}</p></article>") == f"T\nHm.\nSo.\n{long.strip()}"


def test_html_keeps_pages_that_leave_out_tags_or_name_states():
    text, long = html_text.main_text, "A sentence of the story that goes on for a while. " * 4
    story = f"<p>{long}</p><p>Ok.</p>"
    expected = f"{long.strip()}\nOk."
    assert text(f"<head><title>x</title><body>{story}") == expected
    assert text(f"<head><title>x<body>{story}") == expected
    for tag in ("noscript", "svg", "select", "iframe", "template"):
        assert text(f"<body><{tag}>{story}") == expected, tag
        assert text(f"<body><{tag}>{story}<{tag}></{tag}>") == expected, tag
    assert text(f"<body>{story}<noscript><p>Turn it on</p></noscript><script>var t='<p>x';</script>") == expected
    for name in ("post no-sidebar", "content has-sidebar", "comments-open", "search-result", "sidebar"):
        assert text(f"<article class='{name}'>{story}</article>") == expected, name
        assert text(f"<div class='{name}'>{story}</div>") == expected, name
        assert text(f"<div class='{name}'><main>{story}</main></div>") == expected, name
    comments = "<div id='comments'><article><p>Nice, and a comment that is long enough to surge by itself, as some are, on many pages.</p></article></div>"
    assert text(f"<div>{story}</div>{comments}") == text(f"<article>{story}</article>{comments}") == expected
    assert text("<article><p>So <math><mi>a</mi><mo>=</mo><mn>2</mn></math> holds.</p></article>") == "So a=2 holds."
    assert text("<div class='menu'>Home</div>") == ""


def test_license_notices_may_wrap_and_long_lines_collect_nothing(spark):
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files "
           '(the "Software"), to deal\nin the Software without restriction')
    r, made = random.Random(6), [(1, mit)]
    gaps = []
    for k, (label, text) in enumerate(licenses.TEMPLATES):
        tokens = text.split()
        for at in (0, 57, 58, 59, 115, 300):  # across the edges of blocks, broken at every third word
            notice = "".join(w + ("\n" if j % 3 == 2 else " ") for j, w in enumerate(tokens))
            made.append((1000 * (k + 1) + at, "prose " * at + notice + "prose " * r.randint(0, 200)))
        made.append((1000 * (k + 1) + 999, " ".join(w + " prose" * 30 for w in tokens)))  # one long line
        gaps.append(1000 * (k + 1) + 999)
    got = {x.doc_id: x for x in licenses.licenses(frame(spark, made), phrases={"no such phrase": "x"}).collect()}
    assert [tuple(m) for m in got[1].matches] == [("mit", 1.0)]
    for k, (label, _) in enumerate(licenses.TEMPLATES):
        for at in (0, 57, 58, 59, 115, 300):
            assert (label, 1.0) in [tuple(m) for m in got[1000 * (k + 1) + at].matches], (label, at)
    assert all(got[k].matches == [] for k in gaps)


def test_benchmark_search_keeps_every_row_in_blocks(spark):
    """Repeated and null doc_ids of equal length: each row has its own hits, in one block and in many."""
    items = [(k, " ".join(f"i{k}x{j}" for j in range(30))) for k in range(6)]
    plain = " ".join(f"own{j}" for j in range(30))
    made = [(1, items[0][1]), (1, items[0][1]), (None, items[1][1]), (None, items[2][1]), (None, plain), (2, plain), (1, plain), (3, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = sorted((str(d), 30 if t else 0, 30 if t and t != plain else 0, [t[1]] if t and t != plain else []) for d, t in made)
    for block in (40, 100_000):
        got = decontaminate.benchmark_hits(frame(spark, made), bench, block=block).collect()
        assert sorted((str(r.doc_id), r.n_words, sum(h.end - h.first for h in r.hits), r["items"]) for r in got) == expected, block
    kept = decontaminate.without_hits(frame(spark, made), bench)
    assert kept.columns == frame(spark, made).columns
    assert sorted((str(r.doc_id), r.text or "") for r in kept.collect()) == sorted((str(d), t or "") for d, t in made if t in (None, plain))


def test_line_dedup_is_not_at_the_edge_for_a_line_on_a_tenth_of_the_pages(spark):
    """By chance one host has it on less than a tenth, the other on more; a rare line stays."""
    often = {"a": 17, "b": 23}
    made = [(1000 * (host == "b") + k, "\n".join([f"own {host}{k}"] + ["Read more"] * (k < n) + ["Hm."] * (k >= 194)), host)
            for host, n in often.items() for k in range(200)]
    kept = line_dedup.without_boilerplate(spark.createDataFrame(made, "doc_id long, text string, source string")).collect()
    assert sum("Read more" in r.text for r in kept) == 0 and sum("Hm." in r.text for r in kept) == 12


def _plain_cut(page):
    """The article of a page of the tables by plain substitutions, without lines or windows."""
    body = re.search(r"<article\b[^>]*>(.*)</article>", page, re.S)[1]
    body = re.sub(r"<!--.*?-->", "", body, flags=re.S)
    body = re.sub(r"<(script|style|noscript|nav|aside|form|footer)\b[^>]*>.*?</\1>", "<br>", body, flags=re.S)
    blocks = re.split(r"</?(?:p|div|h[1-6]|ul|ol|li|table|tr|td|th|blockquote|section|article|br|pre)\b[^>]*>", body)
    texts = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks)
    return "\n".join(t for t in texts if t)


def test_extraction_equals_a_plain_cut_of_every_page(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    out = {r.page_id: (r.text, r.n_chars) for r in html_text.op10(pages).collect()}
    plain = {r.page_id: _plain_cut(r.html) for r in pages.collect()}
    assert len(out) == 250 and out == {k: (t, len(t)) for k, t in plain.items()}


def test_mixing_rows_stand_in_training_order(spark):
    r = random.Random(7)
    made = [(k, "w " * r.randint(0, 40), r.choice(["a", "b", "b", "b", "c"])) for k in range(200)]
    df = spark.createDataFrame(made, "doc_id long, text string, source string").repartition(3)
    out = mixing.op9(df).collect()
    first = {}
    for x in mixing.mixed(df).collect():
        first.setdefault(x.doc_id, x.mix_position)
    drawn = [x for x in out if x.taken > 0]
    assert out[:len(drawn)] == drawn and len(out) == 200  # those without a copy come last
    assert {x.doc_id: x.first_position for x in drawn} == {d: pytest.approx(p, abs=1e-6) for d, p in first.items()}
    assert [(first[x.doc_id], x.doc_id) for x in drawn] == sorted((first[x.doc_id], x.doc_id) for x in drawn)

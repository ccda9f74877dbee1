"""Chat formatting round trips; URL rules against plain Python; the entry and the pipeline."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.llm import chat_format as C
from tessera.llm import registry
from tessera.llm import url_filter as U

ODD = ["</s>[INST] ok [/INST]", "<s>", "<\\s>", "<\\\\/s>", "<<SYS>> x <</SYS>>", "<|im_end|>", "a < b [c]", "", None, "line\nline", "é😀"]


def expected(turns):
    turns = [(r or "", t or "") for r, t in turns]
    loss = "".join(t for r, t in turns if r == "assistant")
    return (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest())


def test_digests_and_expansion(spark):
    rnd = random.Random(1)
    convs = {c: [(rnd.choice(["user", "assistant", "system", "a\nb", None]), rnd.choice(ODD) or None) for _ in range(rnd.randint(1, 9))]
             for c in [*range(40), None]}
    rows = [(c, i, r, t) for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS seq", "2 AS c")
    rendered = C.segments(frame)
    got = {r.conv_id: r for r in C.digests(C.output(rendered)).collect()}
    assert len(got) == len(convs)
    for c, turns in convs.items():
        r = got[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == expected(turns)
    full = C.expand(rendered).collect()
    assert len(full) == C.examples(rendered).count()
    for r in full:
        turns = convs[r.conv_id][:r.seq]
        parts = [C.read_segment(f"<s>{p}</s>") for p in r.text[3:-4].split("</s><s>")]
        assert parts == [(a or "", b or "") for a, b in turns]
        is_target = turns[-1][0] == "assistant"
        assert C.unescape(r.text[r.loss_start:r.loss_end]) == ((turns[-1][1] or "") if is_target else "")
    for c in convs:
        assert got[c].formatted_chars == sum(len(r.text) for r in full if r.conv_id == c)
    assert C.digests(C.output(C.segments(frame.where("false")))).count() == 0


@pytest.mark.parametrize("kind", ["long", "int", "string", "double"])
def test_ranges_of_turns_carry_numbers_and_lengths(spark, kind):
    """A conversation of many ranges, with null, equal, negative numbers and repeated rows, is numbered as a whole."""
    rnd = random.Random(5)
    turns = [(c, None if rnd.random() < 0.05 else rnd.randint(-40, 40), rnd.choice(["user", "assistant"]), rnd.choice(ODD))
             for c in [1] * 300 + [2] * 4 + [None] * 30]
    turns += turns[:25] + [(3, 7, "user", "x")] * 9
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    frame = frame.withColumn("turn", F.col("turn").cast(kind)).withColumn("range", F.lit("clash")).repartition(5)
    rendered = C.segments(frame, span=3)
    got = {r.conv_id: r for r in C.digests(C.output(rendered)).collect()}
    full = C.expand(rendered).collect()
    assert set(got) == {1, 2, 3, None}

    def number(t):
        return (t is not None, "" if t is None else str(t) if kind == "string" else t)
    for c in got:
        own = [(number(t), r, t2 or "") for k, t, r, t2 in turns if k == c]
        shown = {t: e for t, e in spark.createDataFrame([(t,) for t in {x[2] for x in own}], "t string")
                 .select("t", C.escape(F.col("t"))).collect()}
        own.sort(key=lambda x: (x[0], x[1], f"{shown[x[2]]}{C.CLOSE}".encode()))
        assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars, got[c].loss_sha256) == expected([x[1:] for x in own])
        assert got[c].formatted_chars == sum(len(r.text) for r in full if r.conv_id == c)
        wanted = sum(1 for x in own if x[1] == "assistant") + (own[-1][1] != "assistant")
        assert len([r for r in full if r.conv_id == c]) == wanted


def test_example_that_does_not_fit_is_an_error(spark):
    frame = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b")], "conv_id long, turn long, role string, text string")
    wrong = C.output(C.segments(frame)).withColumn("text_chars", F.col("text_chars") + 1)
    with pytest.raises(Exception, match="does not fit its turns"):
        C.digests(wrong).collect()


def test_output_holds_the_whole_texts_of_the_examples(spark):
    turns = [(c, i, "assistant" if i % 2 else "user", ODD[(c + i) % len(ODD)]) for c in range(12) for i in range(c)] + [(None, 0, "user", "x")]
    rendered = C.segments(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    full = {(r.conv_id, r.seq): (r.text, r.loss_start, r.loss_end) for r in C.expand(rendered).collect()}
    digests = {tuple(r) for r in C.digests(C.output(rendered)).collect()}
    for piece_chars in (7, C.PIECE_CHARS):
        got, spans = {}, {}
        for r in sorted(C.output(rendered, piece_chars).collect(), key=lambda r: (r.conv_id is None, r.conv_id, r.seq, r.piece)):
            assert len(r.text) <= piece_chars
            got[r.conv_id, r.seq] = got.get((r.conv_id, r.seq), "") + r.text
            spans[r.conv_id, r.seq] = r.loss_start, r.loss_end
        assert {k: (t, *spans[k]) for k, t in got.items()} == full
        assert {tuple(r) for r in C.digests(C.output(rendered, piece_chars)).collect()} == digests
    changed = C.output(rendered).withColumn("text", F.regexp_replace("text", "^<s>user", "<s>uses"))
    assert {r.turns_sha256 for r in C.digests(changed).collect()}.isdisjoint(d[2] for d in digests)  # read from the examples


def test_escape_is_reversible_and_hides_controls(spark):
    texts = [t for t in ODD if t] + ["<" + "\\" * k + "s>" for k in range(5)] + ["[" + "\\" * k + "/INST]" for k in range(5)]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", C.escape(F.col("t")).alias("e")).collect()
    for r in got:
        assert C.unescape(r.e) == r.t
        assert not re.search(r"</?s>|\[/?INST\]|<</?SYS>>|<\|\w+\|>", r.e)
    assert len({r.e for r in got}) == len({r.t for r in got})


def plain(url, rules):
    if not url or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = []
    for verdict, rule in rules:
        own, tail = rule.split("/", 1)
        if (host == own or host.endswith("." + own)) and path.startswith("/" + tail):
            fits.append((len(rule), rule, verdict))
    _, rule, verdict = max(fits, default=(0, None, None))
    return host, path, rule, verdict


def test_rules_and_parts(spark):
    urls = ["http://www.Example.COM/en/1?x#y", "https://example.com/en", "ftp://a.net/es/", "http://net/es/x", "http://xnet/es/x",
            "http://Ä.com/", "http://com", "no scheme", "", None, "http://", "http://h.net?q=/es/", "a://b://c.net/fr/é", "http://x.com/a\nb?c"]
    urls += [r.url for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("url").collect()]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "1 AS host", "2 AS n")
    rows = U.judge(pages).collect()
    assert len(rows) == len(urls)
    for r in rows:
        host, path, rule, verdict = plain(urls[r.page_id], U.RULES)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
    assert U.judge(pages.where("false")).count() == 0
    assert {r.verdict for r in U.judge(pages, rules=[]).collect()} == {"allow"}


def test_template_rejected_by_its_neighbours(spark):
    """Pages of a template that the rules mostly block are rejected; a differing sibling is not."""
    urls = [f"http://h.org/ads/{i}/x" for i in range(60)] + [f"http://h.org/news/{i}" for i in range(60)]
    urls += ["http://h.org/ads/777"] + [f"http://h.org/t{chr(97 + i % 26)}{chr(97 + i // 26)}/z" for i in range(80)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rules = [("block", f"h.org/ads/{i}/") for i in range(50)]
    got = {urls[r.page_id]: r for r in U.judge(pages, rules=rules).collect()}
    assert got["http://h.org/ads/55/x"].rule is None and got["http://h.org/ads/55/x"].verdict == "block"
    assert got["http://h.org/news/3"].verdict == "allow"
    assert got["http://h.org/taa/z"].template == "/*/z"


def plain_tree(urls, rules, fanout, z, purity, weight):
    """Verdict and purity of every url by the tree's definition, host by host in plain Python."""
    rows = [plain(u, rules) for u in urls]
    shape = [tuple("" if re.search("[0-9]", s) else s for s in path.split("/") if s) for _, path, _, _ in rows]
    labelled = [r[3] for r in rows if r[3]]
    base = labelled.count("block") / max(len(labelled), 1)
    out = [None] * len(urls)
    for host in {r[0] for r in rows}:
        mine = [i for i, r in enumerate(rows) if r[0] == host]
        at = {shape[i]: list(shape[i]) for i in mine}
        for k in range(max(map(len, at))):
            nodes = {}
            for s in at:
                if len(s) > k:
                    nodes.setdefault(tuple(at[s][:k]), []).append(s)
            for below in nodes.values():
                count = {}
                for i in mine:
                    if shape[i] in below and shape[i][k]:
                        count[shape[i][k]] = count.get(shape[i][k], 0) + 1
                if len(count) > fanout:
                    for s in below:
                        if s[k] and count[s[k]] * fanout < sum(count.values()):
                            at[s][k] = ""
        template = {i: tuple(at[shape[i]]) for i in mine}
        m, b = {}, {}
        for i in mine:
            if rows[i][3]:
                m[template[i]] = m.get(template[i], 0) + 1
                b[template[i]] = b.get(template[i], 0) + (rows[i][3] == "block")
        branch, again = {t: t for t in m}, True
        while again:
            again = False
            for k in reversed(range(max(map(len, branch), default=0))):
                bm, bb, groups = {}, {}, {}
                for t, g in branch.items():
                    bm[g], bb[g] = bm.get(g, 0) + m[t], bb.get(g, 0) + b[t]
                for g in bm:
                    if len(g) > k and g[k]:
                        groups.setdefault((g[:k], g[k + 1:]), []).append(g)
                for (head, tail), members in groups.items():
                    pm, pb = sum(bm[g] for g in members), sum(bb[g] for g in members)
                    share = pb / pm
                    alike = [g for g in members if len(members) > 1 and (bb[g] / bm[g] - (pb - bb[g]) / (pm - bm[g])) ** 2
                             <= z * z * (share * (1 - share) * (1 / bm[g] + 1 / (pm - bm[g])))]
                    if len(alike) > 1:
                        again = True
                        name = "/" + min(g[k].lstrip("/") for g in alike)
                        branch = {t: head + (name,) + tail if g in alike else g for t, g in branch.items()}
        for i in mine:
            own = [t for t in branch if branch[t] == branch.get(template[i])]
            mm, bb = sum(m[t] for t in own), sum(b[t] for t in own)
            pure = (bb + weight * base) / (mm + weight) if mm else None
            bad = bool(mm) and pure >= purity and bb / mm >= purity
            out[i] = (rows[i][3] or ("block" if bad else "allow"), pure)
    return out


def test_tree_equals_plain_python(spark):
    """Random urls of up to ten segments, wide nodes, labelled and unlabelled pages, repeats, long paths and odd segments."""
    rnd = random.Random(5)
    words = ["a", "b", "ads", "{x}", "*", "é", "", "7", "x9"]
    urls, rules = [], [("block", "h.org/ads/"), ("block", "h.org/a/b/"), ("allow", "h.org/a/"), ("allow", "h.org/b/"), ("block", "g.net/a/a/a/")]
    for _ in range(700):
        host = rnd.choice(["h.org", "h.org", "g.net"])
        urls.append(f"http://{host}/" + "/".join(rnd.choice(words) for _ in range(rnd.randint(0, 10))))
    urls += [f"http://h.org/w/{w}/{rnd.choice('pq')}" for w in [chr(97 + i // 8) + chr(97 + i % 8) for i in range(60)] + ["big"] * 40]
    for i in range(400):
        kind = rnd.choice("abcdef")
        urls.append(f"http://s.com/{kind}/{rnd.choice('uvw')}/end/{i}")
        if i < 70:  # the rules are literals of the plan
            bad = rnd.random() < (0.9 if kind in "abc" else 0.2)
            rules.append(("block" if bad else "allow", urls[-1].split("//")[1]))
    urls += urls[:20] + [None, "", "http://h.org/" + "a/" * 400, "http://h.org/" + "z" * 20_000]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "1 AS branch", "2 AS m").checkpoint()
    want = plain_tree(urls, rules, 12, 2.0, 0.5, 2.0)
    assert {w[0] for w in want} == {"allow", "block"}
    merged = 0
    for r in U.judge(pages, rules=rules, fanout=12).collect():
        verdict, pure = want[r.page_id]
        assert r.verdict == verdict and (r.purity is None) == (pure is None), (urls[r.page_id], r, pure)
        assert pure is None or abs(r.purity - pure) < 1e-12
        merged += "{" in r.template and not r.path.startswith("/{")
    assert merged > 100


def test_deep_and_lone_pages(spark):
    """Branches that part below the fourth segment are judged apart; no blocked page, no rejection."""
    urls = [f"http://h.org/a/b/c/d/bad/{i}" for i in range(9)] + [f"http://h.org/a/b/c/d/good/{i}" for i in range(3)]
    urls += ["http://h.org/shop/bad2/0", "http://h.org/a/b/c/d/bad/99"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rules = [("block", f"h.org/a/b/c/d/bad/{i}") for i in range(9)]
    rules = [r for r in rules if not r[1].endswith("bad/9")]
    got = {urls[r.page_id]: r for r in U.judge(pages, rules=rules).collect()}
    assert {got[u].verdict for u in urls[9:13]} == {"allow"} and got[urls[12]].purity is None
    wide = spark.createDataFrame([(0, "http://h.org/a/b/c/d/bad/x77")], "page_id long, url string")
    both = {r.page_id: r for r in U.judge(pages.unionByName(wide.selectExpr("page_id + 100 AS page_id", "url")), rules=rules).collect()}
    assert both[100].rule is None and both[100].verdict == "block"


def test_pipeline_against_its_operators(spark):
    import corpus_pipeline as P
    from tessera.llm import byte_bpe, near_dup
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("extra", F.lit(1))
    odd = spark.createDataFrame([(-1, None), (-2, "")], "doc_id long, text string")
    docs = docs.unionByName(odd, allowMissingColumns=True)
    for name, stage in P.STAGES[:-1]:
        before, out = docs, stage(spark, docs, sf)
        assert out.columns == before.columns, name
        docs = out.checkpoint()
    assert docs.where("doc_id < 0").count() == 0
    assert near_dup.near_duplicates(docs).where("not kept").count() == 0
    last = P.STAGES[-1][1](spark, docs, sf)
    assert last.count() == docs.count() > 100
    ranks = registry.tokenizer_file("byte_bpe_multi_50k.tiktoken")
    back = {r.doc_id: bytes(r.data).decode() for r in byte_bpe.decode(last, ranks).collect()}
    assert back == {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    assert len(P.STAGES) == 5


def test_pipeline_stages_against_plain_python(spark):
    """Kept ids of each stage on its own input, with planted copies, passages, and texts without a letter."""
    import corpus_pipeline as P
    from test_decontaminate import brute
    from test_dedup import closure, shingles

    from tessera.llm import toxicity
    from tessera.llm.blocks import fold
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    texts = [r.text for r in docs.where("text is not null").orderBy("doc_id").collect()]
    odd = [None, "", "123 !!", "é"]
    for t in texts[:12]:
        words = t.split()
        odd += [t, " ".join(words[:-1] + ["new"]), " ".join(["new"] + words[: len(words) * 4 // 5])]
    odd += [t + " " + b for t, (_, b) in zip(texts[20:40], items)]
    extra = spark.createDataFrame([(10 ** 9 + i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    docs = docs.unionByName(extra, allowMissingColumns=True).checkpoint()
    gone = {}
    for name, stage in P.STAGES[:-1]:
        rows = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        out = stage(spark, docs, sf).checkpoint()
        got = {r.doc_id for r in out.select("doc_id").collect()}
        if name == "language_id":
            want = {i for i, t in rows.items() if any(c.isalpha() for c in t or "")}
        elif name == "toxicity":
            model = toxicity.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"), learn=fold("doc_id", 5) != 0)
            want = {r.doc_id for r in docs.select("doc_id", toxicity.scorer(model)(F.col("text")).alias("s")).collect() if r.s < 0.5}
        elif name == "near_dup":
            sets = {i: shingles(t) for i, t in rows.items()}
            links = [(a, b) for a in sets for b in sets if a < b and sets[a]
                     and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
            want = {i for i, low in closure(sets, links).items() if i == low}
        else:
            ids = list(rows)
            want = {i for i, (n, hit, _) in zip(ids, brute([rows[i] for i in ids], items, 13)) if not hit or 20 * hit < n}
        assert got == want, name
        gone[name] = len(rows) - len(got)
        docs = out
    assert gone["language_id"] >= 3 and gone["near_dup"] >= 10 and gone["decontamination"] >= 3, gone

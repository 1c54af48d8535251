"""Tokens, counts, archive, wrappers, fingerprints: round trips, the libraries themselves, brute force."""

import base64
import hashlib
import json
import struct

import public_tokenizers
import pytest
import tiktoken
import xxhash

from quotegrid.llm import byte_bpe, fingerprints, token_counts, warc, wrappers

RANKS, JSON = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [None, "", " ", "plain words here", "tabs\t\tand\n\nlines  end ", "naïve café 中文字 \U0001F600 é", "x" * 5000, "a<|endoftext|>b  <|endoftext|>",
         "don't we'll 123 4567!!", "same", "same", "\x1c\x85  mixed", "word " * 3000]


@pytest.fixture(scope="module")
def docs(spark):
    # extra columns whose names clash with results; a repeated row
    rows = [(i, t, "en", "s", 1, True) for i, t in enumerate(TEXTS)] + [(9, "same", "en", "s", 1, True)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_tokens int, kept boolean")


def test_bpe_is_the_library_and_comes_back(spark, docs):
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})
    got = byte_bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert len(got) == len(TEXTS) + 1
    for r in got:
        text = TEXTS[r["doc_id"]] or ""
        ids = own.encode_ordinary(text)
        assert r["n_tokens"] == len(ids) and r["n_bytes"] == len(text.encode())
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert byte_bpe.round_trip(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_offsets_and_split_characters(spark):
    text = "né \U0001F600中"
    row = byte_bpe.encode(spark.createDataFrame([(1, text)], "doc_id long, text string"), RANKS, public_tokenizers.PATTERN).head()
    table = byte_bpe.token_table(RANKS)[0]
    at = 0
    for i, end, char in zip(row["ids"], row["byte_ends"], row["char_starts"], strict=True):
        assert text.encode()[at:end] == table[i]
        assert len(text.encode()[: at + 1].decode(errors="ignore")) in (char, char + 1)
        at = end
    first = b"".join(table[i] for i in row["ids"][:-1])
    assert "�" in byte_bpe.decode_text(first) or byte_bpe.decode_text(first) == text[:-1]


def test_counts_are_the_library(spark, docs):
    library = token_counts.tokenizer(JSON)
    for frequent in (0, 1 << 15):
        got = token_counts.token_counts(docs, JSON, frequent=frequent).collect()
        assert len(got) == len(TEXTS) + 1
        for r in got:
            text = TEXTS[r["doc_id"]] or ""
            n = len(library.encode(text, add_special_tokens=False).ids)
            assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 1024)
    assert token_counts.token_counts(docs.limit(0), JSON).count() == 0
    pieces = public_tokenizers.path("piece_bpe_32k.model")
    assert token_counts.token_counts(docs, pieces).count() == len(TEXTS) + 1


PAGES = [(1, "http://a.b/1", "<p>x</p>"), (5, "http://a.b/2", "<p>x</p>"), (3, None, "<p>x</p>"), (7, "u\nv", None), (8, "w", ""), (9, "z", "é"),
         (9, "z", "é"), (None, "n", "<p>x</p>")]


def test_archive(spark, tmp_path):
    pages = spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id long, url string, html string, record_type string")
    path = warc.write(pages, str(tmp_path / "warc"))
    rows = warc.read(spark, path).collect()
    assert len(rows) == len(PAGES)
    best = {}
    for i, _, h in PAGES:
        if i is not None:
            best[h or ""] = max(best.get(h or "", -1), i)
    for r in rows:
        html = next(h or "" for i, _, h in PAGES if i == r["page_id"])
        assert bytes(r["payload"]).decode() == html and r["payload_bytes"] == len(html.encode())
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
        target = best[html]
        assert (r["record_type"], r["refers_to"]) == (("response", None) if r["page_id"] == target else ("revisit", target))
    assert spark.read.parquet(f"{path}/payloads").count() == 3
    records = [bytes(r["record"]) for r in warc.originals(spark, path).collect()]
    for record in records:  # Content-Length says where each record's block ends
        head, block = record.split(b"\r\n\r\n", 1)
        length = int(next(x for x in head.split(b"\r\n") if x.startswith(b"Content-Length")).split(b": ")[1])
        assert block[length:] == b"\r\n\r\n"
    small = warc.write(pages, str(tmp_path / "small"), min_revisit_bytes=3)
    assert {r["record_type"] for r in warc.read(spark, small).where("payload_bytes < 3").collect()} == {"response"}
    assert warc.archive_and_read(pages.limit(0)).count() == 0


def test_damaged_payload_is_found(spark, tmp_path):
    pages = spark.createDataFrame(PAGES[:2], "page_id long, url string, html string")
    path = warc.write(pages, str(tmp_path / "w"))
    spark.createDataFrame([("0" * 64, bytearray(b"other"))], warc.PAYLOADS_SCHEMA).write.mode("append").parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="damaged payload"):
        warc.verified_payloads(spark, path).collect()


def page(body, extra=""):
    return (f"<html><head><title>t</title><script>var a='</p><article>';</script></head><body><nav><ul><li><a href='x'>Home</a></li></ul></nav>{extra}"
            f"<article><h1>T &amp; t</h1>{body}</article><footer>&copy; me</footer>")


def test_wrappers(spark):
    pages = [
        (1, "http://h.x/1", page("<p><b>One<br>two</b>  <i>x</i>.<p>Second&nbsp;par</p>")),
        (2, "http://h.x/2", page("<p>Other</p><ul><li>a<li>b</ul><div class='comments'><p>nice!</p></div>", "<div class=ad>Buy</div>")),
        (3, "http://d.x/1", "<body><div class='menu'><a href=1>m</a></div><div id='content'><h2>H</h2><p>Long text here</p></div><aside>rel</aside>"),
        (4, "http://d.x/2", None), (5, None, ""), (6, "http://h.x/1", "no markup at all"), (6, "http://h.x/1", "no markup at all"),
    ]
    df = spark.createDataFrame([(*p, "c") for p in pages], "page_id long, url string, html string, text string")
    rows = wrappers.main_text(df).collect()
    got = {r["page_id"]: r["text"] for r in rows}
    assert len(rows) == len(pages) and all(r["n_chars"] == len(r["text"]) for r in rows)
    assert got[1] == "T & t\n\nOne two x.\n\nSecond par" and got[2] == "T & t\n\nOther\n\na\n\nb"
    assert got[3] == "H\n\nLong text here" and got[4] == got[5] == "" and got[6] == "no markup at all"
    assert wrappers.main_text(df.limit(0)).count() == 0
    made = {(r["host"], r["kind"]): wrappers.expression(json.loads(r["wrapper"])) for r in wrappers.wrappers(wrappers.parsed(df)).collect()}
    assert "div.ad(#)?" in made["h.x", 0] and "p(#)+" in made["h.x", 0] and "ul(li(#)+)?" in made["h.x", 0]


def texts_of(spark, pages):
    df = spark.createDataFrame([(i, f"http://{host}/{i}", html) for i, (host, html) in enumerate(pages)], "page_id long, url string, html string")
    return {r["page_id"]: r["text"] for r in wrappers.main_text(df).collect()}


def test_layout_classes_keep_the_article(spark):
    art = "<article><h1>Head {0}</h1><p>All of the text number {0} lies here.</p></article>"
    side = "<div class=sidebar><p>aside</p></div><div id=comments><article class=comment><p>I say that this is nice, nice, {0}</p></article></div>"
    cases = [
        f"<body class='has-sidebar'>{art}{side}", f"<div class='layout with-sidebar'>{art}{side}</div><p>top</p>",
        f"<main class='page-search'>{art}</main>{side}", art.replace("<article", "<article class='post legal'") + side,
        f"<div class='postWithComments'>{art}</div>{side}", f"<main><p>crumb</p><div class='hasSidebar'>{art}</div></main>{side}",
        f"<div class='page no-sidebar'>{art.replace('article', 'div')}</div><div class=cookie-notice>Cookies are in use on all of these pages here</div>",
    ]
    pages = [(f"h{i}.x", c.format(n)) for i, c in enumerate(cases) for n in (1, 2)]
    pages += [("all.x", c.format(n)) for c in cases[:6] for n in (1, 2)]  # one host: no page decides for another
    got = texts_of(spark, pages)
    for i in range(len(pages)):
        n = i % 2 + 1
        assert got[i] == f"Head {n}\n\nAll of the text number {n} lies here.", (i, got[i])
    mixed = ("<article><p>Text {0}</p><div class=notice><p>Varies {0}</p></div><div class=notice id=b><p>Same text</p></div><ul><li class=popular>one {0}"
             "<li>two {0}</ul><div class=related><a href=x>link {0}</a></div><div class=newsletter>mail {0}</div></article>")
    got = texts_of(spark, [("m.x", mixed.format(n)) for n in range(4)])
    assert all(got[n] == f"Text {n}\n\nVaries {n}\n\none {n}\n\ntwo {n}" for n in range(4))
    menu = "<div class='main-menu'><p>Menu text one</p></div><div id=content><p>Long text of the page {0}</p></div>"
    assert texts_of(spark, [("n.x", menu.format(1))])[0] == "Long text of the page 1"


def test_constant_blocks_of_an_article_stay(spark):
    copies = [("c.x", "<article><h1>Head</h1><p>One text.</p><p>Two.</p></article>")] * 4
    same = [("s.x", f"<article><h2>Summary</h2><p>a {n}</p><p>b</p></article>") for n in range(4)]
    named = [("d.x", f"<div class=content><h2>Background</h2><div>All rights</div><p>a {n}</p></div>") for n in range(4)]
    twice = [("t.x", f"<div class=content><div>Part</div><p>a {n}</p></div>") for n in (0, 1) for _ in range(3)]
    got = texts_of(spark, copies + same + named + twice)
    assert {got[i] for i in range(4)} == {"Head\n\nOne text.\n\nTwo."}
    assert all(got[4 + n] == f"Summary\n\na {n}\n\nb" and got[8 + n] == f"Background\n\na {n}" for n in range(4))
    assert got[12] == "Part\n\na 0" and got[15] == "Part\n\na 1"  # two pages, six rows


def test_links_are_judged_on_the_page_and_outside_articles(spark):
    refs = "<ul><li><a href=x>Reference one {0}</a><li><a href=y>Reference two</a><li>plain {0}</ul>"
    pages = [("r.x", f"<article><p>Text {n}.</p>{refs.format(n)}</article>") for n in range(3)]
    many = "".join(f"<li><a href=x>link number {i} of a long list of them</a>" for i in range(40))
    pages += [("o.x", f"<div class=content><p>Text {n}.</p><ul><li>item {n}<li>item</ul></div>") for n in range(3)]
    pages += [("o.x", f"<div class=content><p>Text 3.</p><ul>{many}</ul></div>")]
    got = texts_of(spark, pages)
    assert all(got[n] == f"Text {n}.\n\nReference one {n}\n\nReference two\n\nplain {n}" for n in range(3))
    assert all(got[3 + n] == f"Text {n}.\n\nitem {n}\n\nitem" for n in range(3)) and got[6] == "Text 3."


def spark_hash(value, seed=42):
    raw = value.encode() if isinstance(value, str) else struct.pack("<q", value)
    h = xxhash.xxh64_intdigest(raw, seed=seed)
    return h - (1 << 64) if h >> 63 else h


def winnow(text, k=fingerprints.K, w=fingerprints.W):
    units = [u[i:i + fingerprints.UNIT] for u in text.split() for i in range(0, len(u), fingerprints.UNIT)]
    if not units:
        return []
    if len(units) < k:
        grams = [spark_hash(" ".join(units))]
    else:
        grams = [spark_hash(u) for u in units]
        for _ in range(k - 1):  # k = 3: pairs, then pairs of pairs
            grams = [spark_hash(b, spark_hash(a) % (1 << 64)) for a, b in zip(grams, grams[1:])]
    top = [g >> fingerprints.POSITION_BITS for g in grams]
    out = []
    for i in range(max(1, len(top) - w + 1)):
        best = min(top[i:i + w])
        at = max(j for j in range(i, min(i + w, len(top))) if top[j] == best)
        if (best, at) not in out:
            out.append((best, at))
    return out


def test_fingerprints_equal_brute_force(spark):
    texts = {40: "the cat sat on the mat and the cat sat on the mat again", 31: "one two", 30: None, 12: "", 7: "abcdefghijklmnop " * 4,
             3: "the cat sat on the mat and something else follows here now", -5: "same text twice ", 2000: "same text twice ", 5000: "z a b c d e f g"}
    df = spark.createDataFrame([(i, t, 1.0) for i, t in texts.items()], "doc_id long, text string, near_edited double")
    got = {r["doc_id"]: r for r in fingerprints.edit_probe(df).collect()}
    order = sorted(texts, reverse=True)
    bits = (1 << 40) - 1

    def show(marks):
        return " ".join(f"{h & bits:x}:{i}" for h, i in marks)

    for d, after in zip(order, order[1:] + order[:1], strict=True):
        text, following = texts[d] or "", texts[after] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        own, other, third = ({h for h, _ in winnow(t)} for t in (text, edited, following))
        like = lambda a, b: 1.0 if not a and not b else len(a & b) / len(a | b)
        r = got[d]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == show(winnow(text)) and r["edited_fingerprint"] == show(winnow(edited))
        assert r["near_edited"] == pytest.approx(like(own, other)) and r["near_next"] == pytest.approx(like(own, third))
    assert fingerprints.edit_probe(df.limit(0)).count() == 0


def test_next_lower_over_levels(spark):
    keys = [5, -3, 1 << 40, 7, 6, 3000, 100_000, (1 << 40) + 1]
    df = spark.createDataFrame([(k,) for k in keys], "key long")
    want = dict(zip(sorted(keys), [None, *sorted(keys)[:-1]], strict=True))
    assert {r["key"]: r["lower"] for r in fingerprints.next_lower(df, most=2, bits=2).collect()} == want


def test_repeated_and_missing_ids_do_not_crash(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "x"), (None, None)], "doc_id long, text string")
    assert fingerprints.edit_probe(df).count() == 4

"""Secret scan, licence scan, quality rules and URL filter against brute force and on odd input."""

import hashlib
import random
import re
from collections import Counter

import duckdb
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from jobtide.llm import check_sql, licenses, quality_rules, secret_scan, url_filter

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, found STRING, row STRING, kept STRING"


def odd(spark, texts, schema=DOCS):
    return spark.createDataFrame([(i, t, "en", "s", 1, "x", "y", "z") for i, t in enumerate(texts)], schema)


def searched(text):
    found = [(m.start(), 0, m.end()) for m in secret_scan.ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


PIECES = st.sampled_from(
    "password PASSWD Secret token api_key apikey AKIA akia ABCDEF0123456789 0123456789abcdef deadBEEF dead = : ' \" \n ſecret Key İ ß é ghp_ "
    "abcdefghijklmnop + / . - _ = aaaaaaaaaaaaaaaa".split(" ") + [" ", "  ", "\x00", "secretoken", "token: secret = "]
)


@settings(max_examples=400, deadline=None)
@given(st.lists(PIECES, max_size=14).map("".join))
def test_spans_are_those_of_a_search(text):
    base = [(s, secret_scan.KINDS.index(k), e) for s, k, e in secret_scan.scan(text) if k in secret_scan.BASE_KINDS]
    assert base == searched(text)


def test_checksums():
    body = "".join(random.Random(1).choices(secret_scan.BASE62, k=30))
    good = body + secret_scan.checksum(body)
    bad = body + "000000"
    assert [k for _, k, _ in secret_scan.scan(f"x ghp_{good} npm_{good} ghs_{bad} npm_{good}9")] == ["github", "npm"]


def test_secret_report_on_odd_input(spark):
    texts = [None, "", "no secret", 'token = "' + "a1" * 20 + '"', "x" * 300_000 + " password: abcdefghijkl", 'token = "' + "a1" * 20 + '"']
    rows = secret_scan.report(odd(spark, texts)).orderBy("doc_id").collect()
    assert [(r.n_assign, r.n_access, r.n_hex) for r in rows] == [(0, 0, 0)] * 3 + [(1, 0, 1), (1, 0, 0), (1, 0, 1)]
    assert rows[0].spans == "" and rows[0].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert rows[3].spans == "assign:0:49,hex:9:49" and rows[3].base_sha256 == hashlib.sha256(rows[3].spans.encode()).hexdigest()
    assert secret_scan.report(odd(spark, [])).count() == 0


def test_masking(spark):
    docs = odd(spark, [None, "", "a token = abcdefghijklmnop b", "plain"])
    rows = secret_scan.redact_secrets(docs).orderBy("doc_id").collect()
    assert [r.text for r in rows] == [None, "", "a [REDACTED] b", "plain"]
    assert [r.n_chars for r in rows] == [1, 1, 14, 1]
    assert rows[0].asDict().keys() == set(docs.columns)


def measured(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often, inside = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            inside.update(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside)


def test_measures(spark):
    rng = random.Random(3)
    texts = [None, "", " \n\t", "a", "a b\na b\n\n \na b", "\u00a0 x\u2003y \x1c z", "é|<>" * 9, "a\r\nb\r\nb\r\n", "w " * 40_000]
    texts += [" ".join(rng.choices("ab", k=rng.randint(1, 60))) for _ in range(60)]
    texts += ["\n".join(" ".join(rng.choices("abc", k=9)) for _ in range(rng.randint(1, 9))) for _ in range(30)]
    rows = quality_rules.judge_documents(odd(spark, texts)).orderBy("doc_id").collect()
    for text, r in zip(texts, rows, strict=True):
        want = measured(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, text
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
    assert quality_rules.judge_documents(odd(spark, [])).count() == 0


def test_hosts(spark):
    """A host that fails always goes with all its documents; one with few documents is judged by the others."""
    good = " ".join(f"w{i}" for i in range(40))
    rows = [(f"host{h}", good) for h in range(20) for _ in range(50)] + [("bad", "short")] * 60 + [("bad", good)] * 5
    rows += [("few", "short"), ("few", good), (None, good), (None, None)]
    docs = spark.createDataFrame([(i, h, t, None) for i, (h, t) in enumerate(rows)], "doc_id BIGINT, source STRING, text STRING, measured STRING")
    kept = quality_rules.good_documents(docs)
    assert kept.columns == docs.columns
    assert Counter(r.source for r in kept.collect()) == {**{f"host{h}": 50 for h in range(20)}, "few": 1, None: 1}


def test_url_parts(spark):
    urls = [None, "", "nothing", "HTTP://A.Example.ORG/es/x?q#f", "x://h", "x://h?y/z", "a://b://c/d", "http://h#f://g/", "http://Ä.com/fr/\nx"]
    pages = spark.createDataFrame([(i, u, None, "x", "y") for i, u in enumerate(urls)], "page_id BIGINT, url STRING, html STRING, own STRING, component STRING")
    rows = url_filter.judge(pages).orderBy("page_id").collect()
    assert [(r.host, r.path) for r in rows] == [
        ("", ""), ("", ""), ("", ""), ("a.example.org", "/es/x"), ("h", ""), ("h", ""), ("b:", "//c/d"), ("h", ""), ("Ä.com", "/fr/\nx"),
    ]
    assert [r.verdict for r in rows] == ["allow"] * 3 + ["block"] + ["allow"] * 5
    assert rows[3].rule == "example.org/es/" and rows[8].rule == "com/fr/"
    assert url_filter.judge(pages.where("false")).count() == 0


def test_aliases(spark):
    link = '<link rel="canonical" href="{}">'.format
    rows = [
        (1, "http://one.net/a", link("https://x.com/de/1")),  # blocked by its alias
        (2, "http://two.net/b", link("http://one.net/a#top")),  # by an alias of its alias
        (3, "http://three.net/c", '<META HTTP-EQUIV=refresh content="0; URL=http://y.org/en">'),  # allowed by its alias
        (4, "http://four.net/go?u=1&url=http%3A%2F%2Fx.com%2Fde%2F9", ""),
        (5, "http://x.com/de/1", link("http://y.org/q")),  # a rule of its own; brings an allow to 1 and 2
        (6, "http://six.net/", link("/z/../self")),
        (7, "http://seven.net/p/q", link("r?s&amp;t")),
        (8, "http://four.net/go?url=%zz", None),
    ]
    pages = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING")
    got = {r.page_id: (r.verdict, r.decided_by) for r in url_filter.judge(pages).collect()}
    assert got == {1: ("allow", "alias"), 2: ("allow", "alias"), 3: ("allow", "alias"), 4: ("block", "alias"), 5: ("block", "rule"), 6: ("allow", "default"), 7: ("allow", "default"), 8: ("allow", "default")}
    ends = {tuple(r) for r in url_filter.alias_edges(pages).collect()}
    assert ("seven.net/p/q", "seven.net/p/r?s&t") in ends and ("six.net/", "six.net/self") in ends


# worked out by hand after RFC 3986, 5.2 to 5.4; null: no page
LINKS = {
    "g": "a.net/b/c/g", "./g": "a.net/b/c/g", "g/": "a.net/b/c/g/", "/g": "a.net/g", "//G.net": "g.net/", "?y": "a.net/b/c/d;p?y",
    "g?y": "a.net/b/c/g?y", "#s": None, "g#s": "a.net/b/c/g", ".": "a.net/b/c/", "./": "a.net/b/c/", "..": "a.net/b/", "../": "a.net/b/",
    "../g": "a.net/b/g", "../..": "a.net/", "../../g": "a.net/g", "../../../g": "a.net/g", "/./g": "a.net/g", "/../g": "a.net/g",
    "g.": "a.net/b/c/g.", "..g": "a.net/b/c/..g", "./../g": "a.net/b/g", "./g/.": "a.net/b/c/g/", "g/../h": "a.net/b/c/h",
    "g?y/../x": "a.net/b/c/g?y/../x", "http://h.net/x/../%7e": "h.net/%7e", "mailto:x@y.net": None, "%2e%2e/g": "a.net/b/c/%2e%2e/g",
}


def test_links_are_resolved(spark):
    rows = [(link, "http://a.net/b/c/d;p?q", f'<link rel=canonical href="{link}">') for link in LINKS]
    pages = spark.createDataFrame(rows, "page_id STRING, url STRING, html STRING")
    for link, goal in LINKS.items():
        ends = {r.b for r in url_filter.alias_edges(pages.where(F.col("page_id") == link)).collect()}
        assert ends == ({goal} if goal else set()), link


def test_aliases_equal_the_check_sql(spark, tmp_path):
    goals = [*LINKS, "http://x.com/de/1", "../de/../../fr/2", "http://example.org/es/./3", "http://y.org/e"]
    rng = random.Random(5)
    hosts = ["a.net", "b.net", "x.com", "www.example.org", "y.org"]
    address = lambda: f"http://{rng.choice(hosts)}/{rng.choice(['b/c', 'de', 'fr', 'es', '.', 'b/..'])}/{rng.randrange(12)}"
    rows = []
    for i in range(300):
        goal = rng.choice([*goals, address(), address(), f"./{rng.randrange(12)}", f"../de/{rng.randrange(12)}", f"?x={rng.randrange(3)}"])
        form = rng.choice(["", '<link rel=canonical href="{}">', '<meta http-equiv=refresh content="0; url={}">'])
        rows.append((i, rng.choice([address(), address() + "?x=1"]), form.format(goal)))
    rows += [(300, None, None), (301, "http://k.net/b/1", '<link rel=canonical href="../2">'), (302, "http://k.net/2", '<link rel=canonical href="//x.com/fr/../de/77">')]
    pages = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING")
    pages.write.parquet(str(tmp_path / "pages"))
    columns = "page_id, host, path, rule, verdict, decided_by"
    found = url_filter.judge(pages).selectExpr(columns.split(", ")).collect()
    base = duckdb.connect()
    base.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages/*.parquet'")
    wanted = base.execute(f"SELECT {columns} FROM ({check_sql.URLS})").fetchall()
    assert sorted(map(tuple, found), key=repr) == sorted(wanted, key=repr)
    assert {r.decided_by for r in found} == {"rule", "alias", "default"} and {r.verdict for r in found if r.decided_by == "alias"} == {"allow", "block"}


def test_long_alias_chains_and_stars(spark):
    chain = [(i, f"http://c.net/{i}", f'<link href="http://c.net/{i + 1}" rel=canonical>') for i in range(40)]
    star = [(100 + i, f"http://s.net/{i}", "<link rel='canonical' href='http://hub.com/de/x'>") for i in range(200)]
    rows = [*chain, (40, "http://c.net/40", "<link rel=canonical href=http://w.com/de/>"), *star]
    got = url_filter.judge(spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING")).collect()
    assert {r.verdict for r in got} == {"block"} and len(got) == 241


def test_licences(spark):
    texts = [None, "", "and so on", "line\nReleased under the MIT License.\nmore words here", "Licensed under the Apache License, Version 2.0.", "MIT", "the license of the", "w " * 50_000]
    rows = licenses.report(odd(spark, texts)).orderBy("doc_id").collect()
    assert [r.licences for r in rows] == ["", "", "", "MIT", "Apache", "", "", ""]
    assert rows[3].paragraphs == "1:MIT"
    assert licenses.report(odd(spark, [])).count() == 0


def test_licences_of_planted_lines(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    planted = {"Apache License": "Apache", "MIT License": "MIT", "GNU General Public": "GPL", "CC BY-NC": "CC-BY-NC"}
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in licenses.report(docs).collect():
        assert r.licences == ",".join(sorted({f for line, f in planted.items() if line in texts[r.doc_id]}))


@pytest.mark.parametrize("family", sorted(licenses.TEMPLATES))
def test_every_template_is_known(family):
    model = licenses.fit([["and", "so", "on", str(i)] for i in range(50)])
    for template in licenses.TEMPLATES[family]:
        assert licenses.classify(model, template)[0] == family
    assert licenses.classify(model, "some words that no licence would ever hold")[0] == licenses.UNKNOWN


@pytest.fixture(scope="module")
def licence_model():
    rng = random.Random(5)
    return licenses.fit([rng.choices([f"w{i}" for i in range(500)], k=rng.randint(5, 300)) for _ in range(300)])


@pytest.mark.parametrize("others", [50, 500, 5_000])
def test_notice_in_a_long_paragraph(licence_model, others):
    rng = random.Random(others)
    prose = [f"w{i}" for i in range(500)]
    for family, templates in licenses.TEMPLATES.items():
        for template in templates:
            before, after = rng.choices(prose, k=others // 2), rng.choices(prose, k=others // 2)
            found = licenses.notices(licence_model, [*before, *licenses.words_of(template), *after])
            assert [f for _, f, _ in found] == [family], template
            assert found[0][0] == others // 2


def test_notices_of_one_paragraph_are_all_found(licence_model):
    text = "Released under the MIT License. " + "w1 w2 w3 w4 " * 40 + "Licensed under CC BY-NC 4.0. Released under the MIT License."
    assert [f for _, f, _ in licenses.notices(licence_model, licenses.words_of(text))] == ["MIT", "CC-BY-NC", "MIT"]
    assert licenses.notices(licence_model, licenses.words_of("a version of the software is under the general terms " * 50)) == []


def found_in(model, text):
    return [(lines[i], f) for words, lines in licenses.paragraphs_of(text) for i, f, _ in licenses.notices(model, words, lines)]


GPL_HEADER = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""
LGPL_HEADER = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version."""
LGPL_PROGRAM = GPL_HEADER.replace("GNU General Public License", "GNU Lesser General Public License")
MIT_HEADER = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell"""
APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License."""
WRAPPED = {"GPL": [GPL_HEADER], "LGPL": [LGPL_HEADER, LGPL_PROGRAM], "MIT": [MIT_HEADER], "Apache": [APACHE_HEADER]}


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// ", "    "])
def test_wrapped_notices(licence_model, mark):
    rng = random.Random(mark)
    for family, headers in WRAPPED.items():
        for header in headers:
            lines = ["".join([mark, x]) for x in header.split("\n")]
            code = [" ".join(rng.choices([f"w{i}" for i in range(500)], k=12)) for _ in range(6)]
            assert found_in(licence_model, "\n".join(lines)) == [(0, family)], header
            assert found_in(licence_model, "\n".join([*code, *lines, *code])) == [(6, family)], header
            assert found_in(licence_model, "\n".join([*code, mark, *lines, mark, *code])) == [(7, family)], header


def test_notices_on_lines_after_each_other(licence_model):
    text = "Released under the MIT License.\nLicensed under CC BY-NC 4.0.\nReleased under the MIT License.\n"
    assert found_in(licence_model, text + "Licensed under the Apache License, Version 2.0.") == [(0, "MIT"), (1, "CC-BY-NC"), (2, "MIT"), (3, "Apache")]


PLANTED = {
    "Licensed under the Apache License, Version 2.0.": ("Apache", ""),
    "Released under the MIT License.": ("MIT", ""),
    "This work is licensed under the GNU General Public License, version 3.": ("GPL", ""),
    "Licensed under CC BY-NC 4.0.": ("CC-BY-NC", ""),
    "All rights reserved.": ("", "AllRightsReserved"),
}


def test_all_five_planted_lines(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    first = docs.where("text IS NOT NULL").orderBy("doc_id").first().text
    added = spark.createDataFrame([(-1 - i, f"{first}\n{line}\n{first}") for i, line in enumerate(PLANTED)], docs.schema)
    docs = docs.union(added)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in licenses.report(docs).collect():
        want = [names for line, names in PLANTED.items() if line in texts[r.doc_id]]
        assert r.licences == ",".join(sorted({w for w, _ in want if w})), texts[r.doc_id]
        assert r.other_notices == ",".join(sorted({w for _, w in want if w})), texts[r.doc_id]


UNLISTED_NOTICES = [
    "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above",
    "This program and the accompanying materials are made available under the\nterms of the Eclipse Public License 2.0 which is available at",
    "Permission is granted to anyone to use this software for any purpose,\nincluding commercial applications, and to alter it and redistribute it\nfreely, subject to the following restrictions:",
    "Licensed under the Frobnicate License, Version 2.0.",
    "Released under the Quux Community License.",
    "SPDX-License-Identifier: Zlib",
    "Licensed under EPL-2.0.",
    "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU Affero General Public License as published by",
]


@pytest.mark.parametrize("notice", UNLISTED_NOTICES)
def test_notices_of_no_known_family_are_unknown(licence_model, notice):
    assert found_in(licence_model, notice) == [(0, "unknown")]
    assert found_in(licence_model, f"w1 w2 w3\nw4 w5\n{notice}\nw6 w7 w8") == [(2, "unknown")]


def test_prose_about_licences_is_no_notice(licence_model):
    for prose in ("the license of the house", "it was released under the moon", "all rights", "the driving licence that was lost under the table"):
        assert found_in(licence_model, prose) == []
        assert licenses.classify(licence_model, prose)[0] == licenses.UNKNOWN


def test_prose_is_chosen_from_all_sampled_documents(spark, monkeypatch):
    texts = ["\n".join(f"doc{i} line{j} w" for j in range(30)) for i in range(40)] + ["long " + "w " * 400]
    seen = []
    monkeypatch.setattr(licenses, "fit", seen.extend)
    licenses.train(odd(spark, texts).select("doc_id", "text"), paragraphs=300)
    assert len(seen) == 300 and max(map(len, seen)) <= licenses.WINDOW
    # by id the first ten documents would have supplied them all
    assert len({words[0] for words in seen if words[0].startswith("doc")}) > 35

"""URL verdicts, licenses and chat formatting."""

import random

import pytest

from millrace.llm import licenses
from millrace.llm.chat import format_chats, maximal_conversations, prefix_hashes
from millrace.llm.queries import URL_RULES
from millrace.llm.url_filter import judge_urls, propagate
from tests_llm_helpers import rows_of


def pages(spark, rows):
    return spark.createDataFrame([(k, u, h, "x", "y") for k, (u, h) in enumerate(rows)],
                                 "page_id long, url string, html string, host string, verdict string")


def test_url_rules(spark):
    urls = [None, "no scheme", "http://A.COM/x", "http://a.com", "http://www.example.com/en/1", "http://m.example.com/en/1?x",
            "https://b.net/es/#t", "https://b.net/es", "https://c.org?x://y/z", "ftp://notexample.com/en/", "http:///p"]
    got = rows_of(judge_urls(pages(spark, [(u, None) for u in urls]), URL_RULES), "page_id", "host", "path", "rule", "verdict")
    assert [r[1:4] for r in sorted(got)] == [
        ("", "", None), ("", "", None), ("a.com", "/x", "com/"), ("a.com", "", None),
        ("www.example.com", "/en/1", "www.example.com/en/"), ("m.example.com", "/en/1", "example.com/en/"),
        ("b.net", "/es/", "net/es/"), ("b.net", "/es", None), ("c.org", "", None), ("notexample.com", "/en/", "com/"),
        ("", "/p", None)]


def test_distrust_flows_backwards_and_trust_forwards(spark):
    link = '<a href="https://{}/p">x</a>'
    rows = [("http://good.com/x", link.format("friend.org")), ("http://friend.org/1", ""),
            ("http://farm.org/1", link.format("BAD.net") + link.format("bad.net")), ("http://bad.net/es/1", ""),
            ("http://bad.net/en/1", '<a href="/own">x</a>'), ("http://alone.org/", None),
            ("http://ring.org/", link.format("farm.org"))]
    got = {r["page_id"]: r["verdict"] for r in judge_urls(pages(spark, rows), URL_RULES).collect()}
    assert got == {0: "allow", 1: "allow", 2: "block", 3: "block", 4: "block", 5: "allow", 6: "block"}
    assert judge_urls(pages(spark, []), URL_RULES).count() == 0


def test_distrust_reaches_the_far_end_of_a_chain(spark):
    link = '<a href="https://{}/p">x</a>'
    rows = [(f"http://h{k}.org/", link.format(f"h{k + 1}.org" if k < 14 else "bad.net")) for k in range(15)]
    got = judge_urls(pages(spark, [*rows, ("http://bad.net/es/1", ""), ("http://alone.org/", "")]), URL_RULES).collect()
    assert {r["page_id"]: r["verdict"] for r in got} == {**dict.fromkeys(range(16), "block"), 16: "allow"}
    assert all(abs(r["distrust"] / (0.15 * 0.85 ** (15 - r["page_id"])) - 1) < 1e-9 for r in got if r["page_id"] < 15)


def test_scores_of_a_ring_converge(spark):
    links = spark.createDataFrame([(f"h{k}", f"h{(k + 1) % 3}", 1) for k in range(3)], "src string, dst string, w long")
    seeds = spark.createDataFrame([("h0", 1, 1), ("h1", 0, 0)], "host string, trusted long, blocked long")
    got = {r["host"]: (r["trust"], r["distrust"]) for r in propagate(links, seeds).collect()}
    whole = 0.15 / (1 - 0.85 ** 3)
    for k in range(3):
        assert abs(got[f"h{k}"][0] / (whole * 0.85 ** k) - 1) < 1e-5
        assert abs(got[f"h{k}"][1] / (whole * 0.85 ** (-k % 3)) - 1) < 1e-5
    with pytest.raises(RuntimeError, match="not converged"):
        propagate(links, seeds, rounds=10)


def test_repeated_pages_and_columns(spark):
    df = pages(spark, [("http://a.com/", "")])
    assert judge_urls(df.unionAll(df), URL_RULES).count() == 2


def scan(docs, *texts):
    got = licenses.scan_licenses(docs(list(enumerate(texts)))).orderBy("doc_id").collect()
    return [(list(r["licenses"]), r["n_sentences"]) for r in got]


def test_licenses(docs):
    mit = "\n\n".join(licenses.SENTENCES[k] for k in ("mit-title", "mit-grant", "mit-condition", "mit-disclaimer"))
    bsd = " ".join(licenses.SENTENCES[k] for k in ("bsd-intro", "bsd-source", "bsd-binary"))
    wrapped = mit.replace(" of ", "\n * of ")
    out_of_order = " ".join(licenses.SENTENCES[k] for k in ("bsd-binary", "bsd-source", "bsd-intro"))
    got = scan(docs, None, "", "a license to nothing", "prose.\nReleased under the  MIT license.\nmore prose", mit, wrapped, bsd,
               bsd + " " + licenses.SENTENCES["bsd-endorse"], out_of_order,
               "Licensed under the Apache License, Version 2.0.\nLicensed under CC BY-NC 4.0.")
    assert got == [([], 0), ([], 0), ([], 0), (["MIT"], 1), (["MIT"], 4), (["MIT"], 4), (["BSD-2-Clause"], 3),
                   (["BSD-3-Clause"], 4), ([], 3), (["Apache-2.0", "CC-BY-NC-4.0"], 2)]
    assert licenses.scan_licenses(docs([])).count() == 0


GPL_3 = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
         "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.")
MPL_2 = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."


def test_headers_that_the_cut_divides(docs):
    after = " If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    wrapped = [t.replace(" of the ", "\n# of the ") for t in (GPL_3, MPL_2 + after)]
    got = [found for found, _ in scan(docs, GPL_3, MPL_2, MPL_2 + after, *wrapped, MPL_2.replace("2.0", "3.0"))]
    assert got == [["GPL-3.0-or-later"], ["MPL-2.0"], ["MPL-2.0"], ["GPL-3.0-or-later"], ["MPL-2.0"], []]


def test_every_rule_is_found_from_its_own_text(docs):
    texts = [" ".join(licenses.SENTENCES[k] for k in rule) for _, rule in licenses.RULES]
    got = [(found, n) for found, n in scan(docs, *texts)]
    assert got == [([name], len(rule)) for name, rule in licenses.RULES]


def test_every_sentence_has_a_trigger_and_a_name():
    import re
    assert all(re.search(licenses.TRIGGER, s, re.I) or "cc by" in s.lower() for s in licenses.SENTENCES.values())
    assert all(name in licenses.SENTENCES for _, rule in licenses.RULES for name in rule)
    assert len({licenses.normalised(s) for s in licenses.SENTENCES.values()}) == len(licenses.SENTENCES)


def test_triggers_hold_whatever_stands_between_words(docs):
    texts = ["This is free and\nunencumbered software released into the public domain.",
             "This is free  and -- unencumbered\tsoftware released into the public domain.",
             "THE\nSOFTWARE IS PROVIDED" + licenses.SENTENCES["mit-disclaimer"].removeprefix("THE SOFTWARE IS PROVIDED"),
             "This program is free\n * software;", "2 -\n0"]
    assert scan(docs, *texts) == [(["Unlicense"], 1), (["Unlicense"], 1), ([], 1), ([], 1), ([], 0)]


def test_titles_and_wrapped_notices_in_one_text(docs):
    s = licenses.SENTENCES
    bsd = [s[k].replace(" the ", "\n// the ") for k in ("bsd-intro", "bsd-source", "bsd-binary")]
    mixed = ("The MIT License (MIT)\nCopyright 2020 A\nLicensed under the Apache License,\nVersion 2.0.\n"
             "Released under\nthe MIT License.")
    after_lines = "MIT License\nfoo bar\n" + "\n".join(bsd) + "\n" + s["bsd-endorse"]
    both = " ".join(bsd) + "\nand\n\n" + " ".join([*bsd, s["bsd-endorse"]])
    assert scan(docs, mixed, after_lines, both) == [
        (["Apache-2.0", "MIT"], 3), (["BSD-3-Clause"], 5), (["BSD-2-Clause", "BSD-3-Clause"], 7)]


def test_sentences_begin_and_end_at_marks(docs):
    assert scan(docs, "Not released under the MIT License.", "Released under the MIT License or not.", "Released under\n\nthe MIT License.",
                "1.0. Fixes.\n2.0. License texts.", "x; Licensed under CC BY 4.0. y", "a|MIT License|b", "Released under|the MIT License.") == [
        ([], 0), ([], 0), ([], 0), ([], 0), (["CC-BY-4.0"], 1), ([], 0), (["MIT"], 1)]


def test_sql_agrees_on_made_up_texts(spark, docs, tmp_path):
    import random

    import check
    from millrace.llm.queries import ORACLES

    rng, parts = random.Random(2), [w for s in licenses.SENTENCES.values() for w in (s, s.replace(" the ", "\nthe "), s.replace(" of ", "\r\n# of "))]
    texts = ["".join(rng.choice(parts) + rng.choice([" ", "\n", "\n\n", "; ", "", "|", " x. "]) for _ in range(rng.randrange(1, 9))) for _ in range(150)]
    df = docs(list(enumerate([None, "", *texts])))
    df.coalesce(1).write.parquet(f"{tmp_path}/documents")
    import os
    part = next(f for f in os.listdir(f"{tmp_path}/documents") if f.endswith(".parquet"))
    os.link(f"{tmp_path}/documents/{part}", f"{tmp_path}/documents.parquet")
    names, want = check.expected(check.connect(tmp_path), ORACLES["op3_license_scan"])
    got = [tuple(r) for r in licenses.scan_licenses(df).select(*names).collect()]
    assert check.rows_of(names, got) == check.rows_of(names, want)


def chats(spark, rows):
    return spark.createDataFrame([(*r, 1, "z") for r in rows], "conv_id long, turn long, role string, text string, pos int, copies string")


def brute_maximal(rows):
    convs = {}
    for c, t, r, x in sorted(set(rows), key=lambda r: (r[0], r[1], r[2] or "", r[3] or "")):
        convs.setdefault(c, []).append((r, x))
    out = {}
    for c, turns in convs.items():
        if not any(len(o) > len(turns) and o[: len(turns)] == turns for o in convs.values()):
            same = sorted(k for k, o in convs.items() if o == turns)
            if c == same[0]:
                out[c] = (len(turns), len(same))
    return out


def test_maximal_conversations(spark):
    rng = random.Random(2)
    rows = []
    for c in range(60):
        for t in range(rng.randrange(1, 6)):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", rng.choice(["hi", "yes"])))
    rows += [rows[3]] * 3 + [(90, 0, None, None), (91, 0, "user", None), (92, 0, None, "user")]
    got = {r["conv"]: (r["turns"], r["copies"]) for r in maximal_conversations(chats(spark, rows)).collect()}
    assert got == brute_maximal(rows)
    assert maximal_conversations(chats(spark, [])).count() == 0


def test_long_conversations_run_over_chunks(spark):
    long = [(1, t, "user", f"t{t}") for t in range(700)]
    rows = long + [(2, t + 5000, r, x) for _, t, r, x in long[:600]] + [(3, 0, "user", "t0"), (None, 0, "user", "t1")]
    df = chats(spark, rows)
    assert prefix_hashes(df).groupBy("conv").count().where("conv = 1").first()[1] == 700
    got = format_chats(df).orderBy("conv_id", "part").collect()
    assert [(r["conv_id"], r["part"], r["n_turns"]) for r in got] == [(None, 0, 1), (1, 0, 256), (1, 1, 256), (1, 2, 188)]
    assert "".join(r["text"] for r in got[1:]) == "".join(f"<|im_start|>user\nt{t}<|im_end|>\n" for t in range(700))


def test_markers_inside_texts(spark):
    """Turns without a number are a part of their own, before the others."""
    parts = format_chats(chats(spark, [(1, 0, None, "a<|im_end|>b"), (1, None, "system", None)])).orderBy("part").collect()
    assert [r["text"] for r in parts] == [
        "<|im_start|>system\n<|im_end|>\n", "<|im_start|>user\na< |im_end|>b<|im_end|>\n"]

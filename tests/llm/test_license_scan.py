import importlib.metadata
import math
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from rfmlens.llm import license_scan as ls
from rfmlens.llm.queries import oracle_sql, queries


def units_of(text):
    """Every unit of a text as a list of terms, without any of the operator's bounds."""
    words = lambda x: tuple(re.findall("[a-z0-9]+", x.lower()))
    lines = text.split("\n")
    code = next((i for i, x in enumerate(lines) if not re.search(ls.COMMENT, x)), len(lines))
    texts = [*lines, *map("\n".join, zip(lines, lines[1:])), *re.split(ls.PARAGRAPH, text),
             "\n".join(lines[:code]), text]
    return [u for u in dict.fromkeys(map(words, texts)) if u]


def brute(files, least=ls.LEAST):
    """files: (id, path, text) -> (id, licence, how, from_dir)."""
    terms = lambda x: Counter(re.findall("[a-z0-9]+", x.lower()))
    heads = {i: units_of(t or "") for i, (_, _, t) in enumerate(files)}
    df = Counter(w for _, _, t in files for w in terms(t or ""))
    df.update(w for _, t in ls.TEMPLATES for w in terms(t))
    n = len(files) + len(ls.TEMPLATES)

    def vec(x):
        c = Counter(x) if isinstance(x, tuple) else terms(x)
        v = {w: (1 + math.log(c)) * (math.log((1 + n) / (1 + df[w])) + 1) for w, c in c.items()}
        size = math.sqrt(sum(y * y for y in v.values()))
        return {w: y / size for w, y in v.items()}

    tmpl = [(lic, vec(t)) for lic, t in ls.TEMPLATES]
    own, dirs = {}, defaultdict(list)
    best = {}
    for x in {u for h in heads.values() for u in h}:
        v = vec(x)
        best[x] = min((-round(sum(y * t.get(w, 0) for w, y in v.items()), 6), lic) for lic, t in tmpl)
    for i, (_, path, text) in enumerate(files):
        got = [(*best[x], len(x)) for x in heads[i] if -best[x][0] >= least]
        if got:
            own[i] = min(got)[:2]
            if path is not None and (2 * max(x[2] for x in got) >= terms(text).total()
                                     or re.search(r"(^|/)(licen[sc]e|copying|notice)(\.[a-z]+)?$", path, re.I)):
                dirs[path.rpartition("/")[0]].append((*own[i], path))
    out = []
    for i, (f, path, _) in enumerate(files):
        lic, how, frm = None, "none", None
        if i in own:
            lic, how = own[i][1], "own"
        elif path is not None:
            d = path.rpartition("/")[0]
            while True:
                if d in dirs:
                    lic, how, frm = min(dirs[d])[1], "inherited", d
                    break
                if not d:
                    break
                d = d.rpartition("/")[0]
        out.append((f, lic, how, frm))
    return sorted(out, key=str)


MIT, APACHE, NC = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", \
    "Licensed under CC BY-NC 4.0."


def test_inheritance_and_edges(spark):
    files = [
        (1, "a/LICENSE", MIT + "\n" + "other words " * 50), (2, "a/x.py", "code"), (3, "a/b/c/y.py", "code"),
        (4, "a/b/NOTICE.txt", NC), (5, "a/b/z.py", "# " + APACHE + "\ncode " * 99), (6, "top.py", "x"),
        (7, None, MIT), (8, None, "nothing"), (9, "a/n", None), (10, "a/e", ""), (11, "q/LICENSE", MIT),
        (11, "q/LICENSE", MIT), (12, "q/COPYING", APACHE), (13, "q/r/s/t/u", "deep"), (14, "ab/x", "not below a"),
        (15, "q/v", "All rights reserved. Copyright 2001 somebody else entirely unrelated"),
        (16, "w/x", "long " * 60_000 + "\n" + NC), (17, "w/y", "inherits nothing"),
    ]
    df = spark.createDataFrame([(*f, 1, "k") for f in files],
                               "doc_id long, path string, text string, line int, dir string")
    got = sorted(((r.doc_id, r.licence, r.how, r.from_dir) for r in ls.scan(df).collect()), key=str)
    assert got == brute(files)
    by = {g[0]: g for g in got}
    assert by[3] == (3, "CC-BY-NC-4.0", "inherited", "a/b") and by[2][1] == "MIT" and by[14][2] == "none"
    assert ls.scan(df.limit(0)).collect() == []


def test_files_at_the_top_license_everything(spark):
    files = [(1, "LICENSE", MIT), (2, "x", "a"), (3, "d/e/f", "b")]
    df = spark.createDataFrame(files, "doc_id long, path string, text string")
    assert sorted(((r.doc_id, r.licence, r.how, r.from_dir) for r in ls.scan(df).collect()), key=str) == brute(files)


BSD = """/*
 * Redistribution and use in source and binary forms, with or without
 * modification, are permitted provided that the following conditions
 * are met:
 * 1. Redistributions of source code must retain the above notice,
 *    this list of conditions and the following disclaimer.
 * 2. Redistributions in binary form must reproduce the above notice, this
 *    list of conditions and the following disclaimer in the documentation
 *    and/or other materials provided with the distribution.
 */
int main(void) { return 0; }
""" + "x = y + z;\n" * 50
WRAPPED = "// Written by somebody.\n// Licensed under the Apache\n// License, Version 2.0.\n" + "code();\n" * 80


def test_bodies_wrapped_statements_and_whole_texts(spark):
    """A body without the word licence, a statement over two lines, a whole licence text under any name."""
    apache = next(f.read_text() for f in importlib.metadata.files("pyarrow") if f.name == "LICENSE.txt")
    apache = apache[:apache.index("END OF TERMS AND CONDITIONS")]
    files = [(1, "a/bsd.c", BSD), (2, "a/wrapped.js", WRAPPED), (3, "lib/terms.txt", apache), (4, "lib/x/y.py", "code"),
             (5, "c/plain.py", "the terms and conditions of this work are under discussion\n" * 9),
             (6, "b/short.py", "# SPDX-License-Identifier: MIT\nimport os\n")]
    df = spark.createDataFrame(files, "doc_id long, path string, text string")
    got = sorted(((r.doc_id, r.licence, r.how, r.from_dir) for r in ls.scan(df).collect()), key=str)
    assert got == brute(files)
    assert [(g[1], g[2]) for g in got] == [("BSD-2-Clause", "own"), ("Apache-2.0", "own"), ("Apache-2.0", "own"),
                                           ("Apache-2.0", "inherited"), (None, "none"), ("MIT", "own")]


def test_own_templates_and_other_thresholds(spark):
    """The bounds drop no unit: every threshold gives what comparing all units gives."""
    files = [(i, f"d{i}/f", t) for i, t in enumerate(
        [MIT, APACHE, NC, BSD, WRAPPED, "under the license of version 2", "MIT", "the public domain\n\nof all",
         "Licensed\nunder\nthe\nMIT\nLicense", "\u0130 Released under the M\u0130T License", "\n\n \n"])]
    df = spark.createDataFrame(files, "doc_id long, path string, text string")
    for least in (0.2, 0.5, 0.9):
        got = sorted(((r.doc_id, r.licence, r.how, r.from_dir) for r in ls.scan(df, least=least).collect()), key=str)
        plain = [(i, p, t.replace("\u0130", " ")) for i, p, t in files]
        assert got == brute(plain, least)
    mine = spark.createDataFrame([(0, "house", "for use inside this house only")],
                                 "template int, licence string, statement string")
    got = ls.scan(spark.createDataFrame([(1, "a/x", "# For use inside\n# this house only.\n" + MIT)],
                                        "doc_id long, path string, text string"), mine).collect()
    assert [(r.licence, r.how) for r in got] == [("house", "own")]


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_sql_agrees(spark, sf):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '/root/testdata/{sf}/documents.parquet'")
    q = con.execute(oracle_sql()["op2_license_scan"])
    cols = [c[0] for c in q.description]
    got = queries()["op2_license_scan"](spark, f"/root/testdata/{sf}").collect()
    assert sorted(map(str, (tuple(r[c] for c in cols) for r in got))) == sorted(map(str, q.fetchall()))
    assert len({r.licence for r in got}) >= 4

"""Archives, licences and conversations."""

import hashlib
import math
import re
import textwrap
from collections import Counter

import pytest
from pyspark.sql import functions as F

from barloom.llm import chat, licence_blocks, licenses, warc


def test_archive_round_trip():
    pages = [(i, f"http://a/{i} x\r\ny", bytes([65 + i % 3]) * (50 * i)) for i in range(400)]
    records = [warc.make_record(i, u, p, hashlib.sha1(p).hexdigest(), None, False) for i, u, p in pages]
    for some in (records, records[:3], []):
        data = warc.make_archive(some)
        assert list(warc.read_archive(data, chunk=1000)) == some
    assert int.from_bytes(warc.make_archive(records)[:4], "little") == warc.DICTIONARY_MAGIC
    got = warc.parse_record(records[9])
    assert got.payload == pages[9][2] and warc.page_of(got.headers["warc-record-id"]) == 9 and "\r" not in got.headers["warc-target-uri"]
    for i in (None, -1, 1 << 62):
        assert warc.page_of(warc.record_id(i, b"12345678")) == i


def test_damaged_archives_are_refused():
    good = warc.make_record(1, None, b"payload", hashlib.sha1(b"payload").hexdigest(), None, False)
    for bad in (good[:-1], good + b"x", good.replace(b"WARC/1.1", b"HTTP/1.1"), good.replace(b"WARC-Type", b"WARC-Tipe"), b""):
        with pytest.raises(ValueError):
            warc.parse_record(bad)
    with pytest.raises(ValueError):
        list(warc.read_archive(warc.make_archive([good])[:-4]))


def test_pages(spark):
    long, other = "ü" * 600, "z" * 1000
    rows = [(1, "u", long), (2, "u", long), (2, "v", long), (9, None, long), (3, "u", other), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (7, "u", ""), (None, "u", long), (None, "u", "q" * 2000), (None, "u", "q" * 2000)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string")
    got = warc.archive_table(df, archive_bytes=2500).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[3], str(r[4]))
    want = []
    for p, _, h in rows:
        data = (h or "").encode()
        revisit = h == long and p != 9
        want.append((p, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", 9 if revisit else None))
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
    assert warc.archive_table(df.limit(0)).count() == 0


def test_licences(spark):
    rows = [
        ("a/LICENSE", "Licensed under the Apache License, Version 2.0.\nmore text"), ("a/x.py", "no words of it"), ("a/b/y.py", "# Released under the MIT License."), ("a/b/c/z.py", None),
        ("a/b/COPYING", "This work is licensed under the GNU General Public License, version 3."), ("top.txt", ""), ("d/LICENSE", "nothing that is known"), ("d/e/f.txt", "he is licensed to drive a very large old car in town"), (None, "Licensed under CC BY-NC 4.0."), ("a/x.py", "again"),
    ]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "path string, text string, license string")
    got = licenses.scan(df).collect()
    assert len(got) == len(rows)
    by = {r.path: r for r in got}
    assert by["a/x.py"].license == "Apache-2.0" and by["a/x.py"].inherited_from == "a" and by["a/x.py"].declared is None
    assert by["a/b/y.py"].license == by["a/b/y.py"].declared == "MIT" and by["a/b/y.py"].inherited_from is None
    assert by["a/b/c/z.py"].license == "GPL-3.0" and by["a/b/c/z.py"].inherited_from == "a/b"
    assert by["top.txt"].license is None and by["d/e/f.txt"].license is None and by["d/LICENSE"].declared is None
    assert licenses.scan(df.limit(0)).count() == 0
    plan = licenses.scan(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("n", [60, 600])
def test_licence_weights_count_every_word(spark, n):
    sentence = "This project is released under the MIT License."
    texts = [sentence, *[f"this project is by us number{i}" if i % 3 else f"other words{i} under the sun" for i in range(n - 1)]]
    df = spark.createDataFrame([(f"d/{i}.txt", t) for i, t in enumerate(texts)], "path string, text string")
    got = {r.path: r for r in licenses.declared(df).collect()}
    words = lambda t: re.findall("[a-z0-9]+", t.lower())
    seen = Counter(w for t in texts for w in set(words(t)))
    vector = lambda t: {w: c * (math.log((1 + n) / (1 + seen[w])) + 1) for w, c in Counter(words(t)).items()}
    a, b = vector(sentence), vector("Released under the MIT License")
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    want = sum(x * b.get(w, 0) for w, x in a.items()) / norm(a) / norm(b)
    assert set(got) == {"d/0.txt"} and got["d/0.txt"].declared == "MIT" and got["d/0.txt"].score == pytest.approx(want, abs=2e-6)


def test_wrapped_notices_and_licence_bodies(spark):
    wrapped = lambda t, mark: "\n".join(mark + x for x in textwrap.wrap(t, 60))
    notices = [(k, t) for k, t in licence_blocks.HEADERS if k in ("GPL-3.0", "LGPL-2.1", "ISC", "BSD-2-Clause", "BSD-3-Clause", "MIT", "Apache-2.0")]
    rows = [(f"src/{k}.py", "# Copyright 2020 A. Body\n" + wrapped(t, "# ") + "\n\nimport os\n", k) for k, t in notices]
    rows += [(f"{k}/LICENSE", f"Copyright 2021 B. Body\n\n{wrapped(t, '  ')}", k) for k, t in licence_blocks.bodies()]
    rows += [("e/x.py", "import os\n\nprint('the terms of any use of it')\n", None), ("f/LICENSE", "we the people of the town and of the land", None), *[(f"g/{i}.txt", "the house of the man and a word of it or this", None) for i in range(50)]]
    df = spark.createDataFrame(rows, "path string, text string, wanted string")
    got = {r.path: r.declared for r in licenses.scan(df).collect()}
    assert got == {p: k for p, _, k in rows}
    plan = licenses.scan(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert licenses.scan(df.limit(0)).count() == 0


LAYOUTS = {
    "shebang": lambda t: "#!/usr/bin/env python3\n\n" + textwrap.indent(t, "# ", lambda _: True) + "\n\nimport os\nprint(os.name)\n",
    "no_blank": lambda t: textwrap.indent(t, "// ", lambda _: True) + "\nint main(int argc, char **argv) { return 0; }\nstatic int x;\n",
    "block": lambda t: "<?php\n/*\n" + t.replace("\n", "\n\n", 3) + "\n*/\nfunction f() { return 1; }\n",
    "stars": lambda t: "package a;\n\n/**\n * Copyright (c) 2019 A. Body\n *\n" + textwrap.indent(t, " * ", lambda _: True) + "\n */\npublic class A { int b; }\n",
    "copyright": lambda t: "# -*- coding: utf-8 -*-\n# Copyright 2020 A. Body\n# Copyright © B. Body\n\n" + textwrap.indent(t, "# ", lambda _: True) + "\nimport os\n",
    "docstring": lambda t: '"""\n' + t + '\n"""\nimport os\n',
    "behind": lambda t: "import os\n\ndef f():\n    return os\n\n" + textwrap.indent(t, "-- ", lambda _: True) + "\n\ndef g():\n    return f\n",
}
OTHER = "the code of a file that is of no licence and of no author but of words"


@pytest.mark.parametrize("crlf", [False, True])
def test_notices_in_any_layout(spark, crlf):
    """Each notice, with its own version, wherever it stands in a file."""
    rows = []
    for i, (k, t) in enumerate(licence_blocks.HEADERS):
        wrapped = "\n".join(textwrap.wrap(t, 66))
        rows += [(f"{i}/{name}.x", lay(wrapped).replace("\n", "\r\n" if crlf else "\n"), k) for name, lay in LAYOUTS.items()]
    rows += [(f"spdx/{i}", f"// SPDX-License-Identifier: {k}\n{OTHER}\n", k) for i, k in enumerate(sorted({k for k, _ in [*licenses.TEMPLATES, *licence_blocks.HEADERS]}))]
    rows += [(f"short/{i}", f"{OTHER}\n# {t}.\n{OTHER}", k) for i, (k, t) in enumerate(licenses.TEMPLATES)]
    prose = ["I wrote about the MIT License in my thesis and released under the MIT License is a phrase.", "He asked me if all this was licensed under the Apache License, Version 2.0 or not at all.", "The GNU General Public License is what they talked about all day long.", "permission to use the car was granted without any fee", "This software is what I like."]
    rows += [(f"prose/{i}", f"{t}\n{OTHER}", None) for i, t in enumerate(prose)]
    rows += [("vague/0", "# This program is free software; you can redistribute it under the terms of the GNU General Public License\n", "GPL"), ("vague/1", "// Licensed under the Apache License.\n", "Apache"), ("vague/2", "Redistribution and use in source and binary forms, with or without modification, are permitted", "BSD")]
    rows += [(f"other/{i}", f"{OTHER} {i}", None) for i in range(150)]
    df = spark.createDataFrame(rows, "path string, text string, wanted string")
    got = {r.path: r.declared for r in licenses.scan(df).collect()}
    assert {p: (got[p], k) for p, _, k in rows if got[p] != k} == {}


def test_licences_of_very_long_files(spark):
    """Pieces of any length: many lines, one long line, many blank lines; the notice stands at the end."""
    notice = "\n".join("# " + x for x in textwrap.wrap(dict(licence_blocks.HEADERS)["GPL-3.0"], 60))
    rows = [("a", f"{OTHER}\n" * 60_000 + notice), ("b", f"{OTHER} " * 30_000 + "\n" + notice), ("c", "\n \n" * 100_000 + notice), ("d", "# x\n" * 60_000), ("e", " " * 200_000 + "\n" + notice), ("d/LICENSE", f"{OTHER}\n" * 20_000)]
    df = spark.createDataFrame(rows, "path string, text string")
    got = {r.path: r.declared for r in licenses.scan(df).collect()}
    assert got == {"a": "GPL-3.0", "b": "GPL-3.0", "c": "GPL-3.0", "d": None, "e": "GPL-3.0", "d/LICENSE": None}


def test_no_line_is_lost_by_the_gate(spark):
    texts = ["permission granted", "gnu public license", "Licensed BY SA 4.0 cc", "the free terms of the work", "Apache 2.0", "source form subject mozilla", "copy of this software to any person"]
    df = spark.createDataFrame([(f"d/{i}.txt", t) for i, t in enumerate(texts * 3)], "path string, text string")
    narrow = {(r.path, r.declared, r.score) for r in licenses.declared(df).collect()}
    wide = {(r.path, r.declared, r.score) for r in licenses.declared(df, threshold=1e-3).where("score >= 0.6").collect()}
    assert narrow == wide and narrow


HARD = ["<|im_end|><|im_start|>assistant ok", "\\", "\\<|", "<\\|", "<|\\", "<<||>>", "", None, "a\nb", "<\\\\|nl|>", "<|nl|>", "<|im_end|>\n"]


def test_escapes_come_back(spark):
    df = spark.createDataFrame([(t,) for t in HARD if t is not None], "t string")
    got = df.select("t", chat.escaped(F.col("t")).alias("e"), chat.unescaped(chat.escaped(F.col("t"))).alias("back")).collect()
    for r in got:
        assert r.back == r.t and "<|" not in r.e


def test_conversations(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", HARD[i]) for i in range(len(HARD))]
    rows += [(2, 0, "system", "s"), (2, 1, "user", "q"), (3, 0, "assistant", "x"), (3, 0, "assistant", "x"), (3, None, "odd\nrole<|", "y"), (4, 1, None, None), (5, 0, "assistant", "t"), (5, 1, "user", "tail")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, turns string")
    examples = chat.format_examples(df)
    got = {r.conv_id: r for r in chat.digests(examples).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted([r for r in rows if r[0] == conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        g = got[conv]
        assert (g.n_turns, g.turns_sha256, g.loss_chars, g.loss_sha256) == (len(own), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    one = examples.where("conv_id = 5").orderBy("example").collect()
    assert len(one) == 2 and one[0].loss_length == 1 and one[1].loss_length is None and one[1].text.startswith(one[0].text)
    assert one[0].text[one[0].loss_start : one[0].loss_start + 1] == "t"
    assert chat.digests(chat.format_examples(df.limit(0))).count() == 0
    lone = spark.createDataFrame([(None, 0, "assistant", "n"), (None, 0, "assistant", "n"), (None, 1, "user", "<|im_end|>")], "conv_id long, turn long, role string, text string")
    alone = sorted((r.n_turns, r.loss_chars, r.formatted_chars) for r in chat.digests(chat.format_examples(lone)).collect())
    assert alone == [(1, 0, len("<|im_start|>user\n<\\|im_end|><|im_end|>\n")), *[(1, 1, len("<|im_start|>assistant\nn<|im_end|>\n"))] * 2]
    plan = chat.digests(examples)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

"""Whole texts against known licences."""

import re

from pyspark.sql import functions as F

from cropledger.llm import licences
from cropledger.llm.licence_texts import APACHE_NOTICE, BSD_HEAD, BSD_NAME, BSD_TAIL, FILES, KNOWN, MIT, UNLICENSE


def found(df, **options):
    return {r.doc_id: (r.licence, r.notices, r.n_notices) for r in licences.scan(df, **options).collect()}


def test_equal_up_to_case_marks_copyright_lines_and_spelling(documents):
    texts = [
        "The MIT License (MIT)\n\nCopyright (c) 2020 Someone\n© 2021 Other\n\n" + MIT,
        MIT.upper().replace(",", " ;").replace("\n", "  \r\n* "),
        MIT.replace("sublicense", "sub-licence").replace("copyright holders", "copyright owners"),
        MIT + " And more.",
        MIT[:-20],
        BSD_HEAD + BSD_NAME + BSD_TAIL,
        UNLICENSE.replace("recognize", "recognise"),
        APACHE_NOTICE.replace("http://", "https://"),
    ]
    got = found(documents(texts))
    assert [got[k][0] for k in range(8)] == ["MIT", "MIT", "MIT", None, None, "BSD-3-Clause", "Unlicense", "Apache-2.0"]


def test_notices_in_lines_nulls_repeats_and_long_texts(documents):
    notice = "Released under the MIT License."
    rows = [
        (0, f"prose\n{notice}\nmore\n{notice}\nLICENCED under the Apache License -- version 2.0"), (1, None), (2, ""),
        (3, "Copyright (c) 2020 Someone"), (4, "x " * 200_000 + "\n" + notice), (5, notice), (None, notice),
    ]
    got = found(documents(rows))
    assert got[0] == (None, "Apache-2.0,MIT", 3)
    assert got[1] == got[2] == got[3] == (None, "", 0)
    assert got[4] == (None, "MIT", 1) and got[5] == ("MIT", "MIT", 1) and got[None] == ("MIT", "MIT", 1)
    assert licences.scan(documents([(1, "a"), (1, "a")])).count() == 2
    assert licences.scan(documents([])).count() == 0


def test_known_texts_differ(spark):
    assert licences.known(spark).count() >= len({name for name, _ in KNOWN})
    forms = spark.createDataFrame(KNOWN, "licence string, text string").select("licence", licences.canonical(F.col("text")).alias("form"))
    assert forms.groupBy("form").agg(F.countDistinct("licence").alias("n")).where("n > 1").count() == 0


def test_copyright_lines_alone_go(spark):
    rows = [("Copyright 2020 A\nkept",), ("COPYRIGHT HOLDERS AND CONTRIBUTORS",), ("  (c) 1999 B, C\nkept",), ("see © 2000",)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(licences.canonical(F.col("t"))).collect()]
    assert got == ["kept", "copyright holders and contributors", "kept", "see 2000"]


def test_every_licence_line_of_the_documents_is_known(spark):
    lines = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select(F.explode(F.split("text", "\n")).alias("text"))
    said = lines.where(F.col("text").rlike(r"(?i)\blicen[cs]e|creative commons|\bCC BY")).distinct()
    rows = licences.scan(said.withColumn("doc_id", F.monotonically_increasing_id())).groupBy("licence").count().collect()
    assert {r.licence for r in rows} == {"CC-BY-NC-4.0", "GPL-3.0", "MIT", "Apache-2.0"} and sum(r["count"] for r in rows) == 4


def test_whole_licences_and_usual_notices(documents):
    texts = {path.stem: path.read_text("utf-8") for path in FILES.glob("*.txt")}
    assert {"Apache-2.0", "GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0", "GFDL-1.3", "Artistic-1.0-Perl"} <= set(texts)
    notices = {
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Licensed under CC BY.": "CC-BY", "License: CC-BY-SA-3.0": "CC-BY-SA-3.0",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.": "CC-BY-ND-4.0",
        "This work is licensed under the Creative Commons Attribution-ShareAlike License": "CC-BY-SA",
        "Released under the GPLv2 or later": "GPL-2.0-or-later", "Distributed under the GNU Lesser General Public License, version 2.1.": "LGPL-2.1",
        "SPDX-License-Identifier: MPL-2.0": "MPL-2.0", "Licensed under the BSD 3-Clause Licence": "BSD-3-Clause",
    }
    got = found(documents([*texts.values(), *notices]))
    assert [got[k][0] for k in range(len(got))] == [*texts, *notices.values()]
    short = texts["Apache-2.0"].split("APPENDIX")[0].replace("  ", " ")
    older = texts["GPL-2.0"].replace("51 Franklin Street, Fifth Floor, Boston, MA 02110-1301", "59 Temple Place, Suite 330, Boston, MA  02111-1307")
    got = found(documents([short, older]))
    assert [got[k][0] for k in range(2)] == ["Apache-2.0", "GPL-2.0"]


def test_copyright_lines_of_every_form_go(documents):
    lines = [
        "Copyright Joyent, Inc. and other Node contributors.", "Copyright The Kubernetes Authors.", "Copyright: 2020 X", "Copyright(c) 2020 X",
        "All rights reserved.", "Copyright by the authors", " * COPYRIGHT JOYENT, INC.\r", "Copyright (c) 2020 X\nAll rights reserved.\nAll rights reserved.\r",
        "// © 2020 X", "Copyright Lawson Software", "copyright ory corp",
    ]
    bsd = BSD_HEAD + BSD_NAME + BSD_TAIL
    got = found(documents([f"{line}\n\n{text}" for line in lines for text in (MIT, bsd)] + lines))
    assert [got[k][0] for k in range(len(got))] == ["MIT", "BSD-3-Clause"] * len(lines) + [None] * len(lines)


def test_lines_of_a_licence_that_start_with_copyright_stay(documents):
    body = [(n, t) for n, t in KNOWN if len(t) > 200 and "copyright" in t.lower()]
    # the words of the licences and not those of the copyright lines that they hold or suggest
    wrapped = [re.sub(r"\s+(?=copyright (?!\(c\)|\[|<|owner\]))", "\n", t, flags=re.I) for _, t in body]
    got = found(documents(wrapped))
    assert {k: n for k, (n, _) in enumerate(body) if got[k][0] != n} == {}
    kept = "No copyright holder is liable.\nAll rights reserved by someone else"
    assert found(documents([f"{MIT}\n{x}" for x in kept.split("\n")])) == {0: (None, "", 0), 1: (None, "", 0)}

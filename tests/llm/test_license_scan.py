"""Known licences are found by their canonical text."""

import re
import textwrap

from hausprep.llm import license_scan, queries

SF = "/root/testdata/sf0.01"


def test_spellings_case_and_copyright_lines(spark):
    docs = [(1, None), (2, ""), (3, "Copyright 2020 X\nRELEASED under the mit LICENCE"), (None, "a"),
            (4, "text\nLicensed under CC BY-NC 4.0.\nmore"), (4, "Licensed under CC BY-NC 5.0.")]
    out = [tuple(r) for r in license_scan.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()]
    assert sorted(out, key=str) == sorted([(1, 0, "", False), (2, 0, "", False), (3, 1, "MIT", True), (None, 0, "", False),
                                           (4, 1, "CC-BY-NC-4.0", False), (4, 0, "", False)], key=str)


def test_whole_table_without_python(spark):
    out = queries.op2_license_scan(spark, SF)
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    lines = {line for _, line in license_scan.KNOWN}
    for r in out.collect():
        assert (r["n_matches"] > 0) == any(x in lines for x in text[r["doc_id"]].split("\n"))
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()


def rewrapped(text, width):
    """Paragraphs wrapped anew; copyright lines stay lines."""
    out = []
    for paragraph in text.split("\n\n"):
        for part in re.split(r"(?im)^(\s*copyright \(c\).*)$", paragraph):
            if re.match(r"(?i)\s*copyright \(c\)", part):
                out.append(part)
                continue
            out += textwrap.wrap(" ".join(part.split()), width, break_on_hyphens=False, break_long_words=False)
        out.append("")
    return "\n".join(out)


def test_real_licence_texts(spark):
    texts = {}
    for name, text in license_scan.full_texts():
        if len(text) > 500:
            texts.setdefault(name, text)
    assert {"MIT", "ISC", "0BSD", "BSD-2-Clause", "BSD-3-Clause", "Zlib", "Apache-2.0", "GPL-2.0", "GPL-3.0", "MPL-2.0"} <= set(texts)
    docs, want = [], {}
    for name, text in texts.items():
        for width in (60, 100_000) if len(text) > 5000 else (37, 60, 100_000):
            changed = rewrapped(text, width).replace("license", "licence").replace("License", "LICENCE")
            own = "Copyright (c) 2021 Some One\nAll rights reserved.\n\n" + changed
            inside = "Some words before.\n# " + own.replace("\n", "\n# ") + "\nSome words after.\n"
            for whole, t in ((True, own), (True, own.upper()), (False, inside)):
                want[len(docs)] = (1, name, whole)
                docs.append((len(docs), t))
        cut = text.rsplit(None, 3)[0]
        if len(text) < 5000 and name != "ISC":      # whose first sentence is a notice too
            want[len(docs)] = (0, "", False)
            docs.append((len(docs), cut))
    mit = texts["MIT"]
    want[len(docs)] = (2, "ISC,MIT", False)
    docs.append((len(docs), "The MIT License (MIT)\n\nCopyright 2020 A\n\n" + mit + "\n--\n" + rewrapped(texts["ISC"], 50)))
    want[len(docs)] = (1, "MIT", True)
    docs.append((len(docs), "The MIT License (MIT)\n\nCopyright 2020 A\n\n" + mit))
    want[len(docs)] = (1, "MIT", False)
    docs.append((len(docs), "x\nReleased under\nthe MIT\nLicense.\ny"))
    out = license_scan.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    wrong = {(r["doc_id"], want[r["doc_id"]], tuple(r)[1:]) for r in out if tuple(r)[1:] != want[r["doc_id"]]}
    assert wrong == set() and len(out) == len(docs)

from importlib.resources import files

from helpers import LONG, ODD, docs
from pyspark.sql import functions as F

from wattlake.llm import licences
from wattlake.llm.licence_texts import NOTICES, TEXTS

MIT = TEXTS[0][1]


def scanned(spark, texts):
    got = licences.scan(docs(spark, [(i, t, None) for i, t in enumerate(texts)])).collect()
    return [(r.licence, list(r.notices)) for r in sorted(got, key=lambda r: r.doc_id)]


def test_known_texts_in_other_dress(spark):
    texts = [t for _, t in TEXTS]
    texts += [MIT.upper(), MIT.replace("\n", "  \n\n"), MIT.replace("<year> <owner>", "2020 Jane Doe\nAll rights reserved."),
              "/* " + MIT.replace("\n", "\n * "), MIT.replace('"', "“"), MIT.replace("License", "Licence"),
              MIT.replace("noninfringement".upper(), "NON-INFRINGEMENT")]
    assert [n for n, _ in scanned(spark, texts)] == [n for n, _ in TEXTS] + ["MIT"] * 7


def test_other_texts_are_no_licence(spark):
    assert scanned(spark, ["x\n" + MIT, MIT + " But no.", MIT.replace("without", "with"), LONG]) == [(None, [])] * 4


def test_notices(spark):
    texts = ["Hi\n  // released under the MIT Licence\nfoo\nlicensed under cc-by-nc 4.0!", "not licensed under CC BY-NC 4.0"]
    assert scanned(spark, texts) == [(None, ["CC-BY-NC-4.0", "MIT"]), (None, [])]
    assert scanned(spark, [t for _, t in NOTICES]) == [(None, [n]) for n, _ in NOTICES]


def test_odd_rows_and_own_lists(spark):
    assert licences.scan(docs(spark, ODD)).count() == len(ODD)
    assert licences.scan(docs(spark, [])).count() == 0
    own = licences.scan(docs(spark, [(1, "Do as You like.", None)]), texts=[("Free", "do as you like")], notices=[("X", "y")])
    assert own.head().licence == "Free"


def test_not_shuffled(spark):
    plan = licences.scan(docs(spark, ODD)).where(F.col("licence").isNull())._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Python" not in plan.replace("PythonRDD", "")


def test_long_texts(spark):
    names = ["Apache-2.0", "Artistic-1.0-Perl", "BSD-3-Clause", "BSL-1.0", "CC0-1.0", "GFDL-1.2", "GFDL-1.3", "GPL-1.0", "GPL-2.0",
             "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "MPL-1.1", "MPL-2.0", "Unlicense"]
    folder = files("wattlake.llm").joinpath("licence_files")
    texts = [folder.joinpath(f"{n}.txt").read_text("utf-8").replace("\n", "\r\n") for n in names]
    assert scanned(spark, texts) == [(n, []) for n in names]
    terms = [t[:t.index("END OF TERMS")] + "End of terms and conditions." for t in texts if "END OF TERMS" in t]
    assert [n for n, _ in scanned(spark, terms)] == ["Apache-2.0", "GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1"]
    assert scanned(spark, [t + "And one more." for t in texts]) == [(None, [])] * len(names)

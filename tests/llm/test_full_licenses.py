"""Full licence texts and further notices."""

from pathlib import Path

import pytest

from termlode.llm import licenses

TEXTS = Path("/usr/share/common-licenses")
BSD = """BSD 2-Clause License

Copyright (c) 2021, A. Nobody

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""


def scanned(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    left = {r["doc_id"] for r in licenses.drop_licenses(docs).collect()}
    found = {r["doc_id"]: r for r in licenses.scan(docs).collect()}
    assert left == {i for i, r in found.items() if r["license_id"] is None}
    return [(found[i]["license_id"], found[i]["notices"]) for i in range(len(texts))]


def test_bsd_text_and_further_notices(spark):
    texts = [BSD, BSD + "\nbut not on Sundays", "prose\nLicensed under CC BY-NC-SA 4.0.\nprose"]
    assert scanned(spark, texts) == [("BSD-2-Clause", ""), (None, ""), (None, "CC-BY-NC-SA-4.0")]


@pytest.mark.skipif(not TEXTS.is_dir(), reason="no licence texts on this machine")
def test_texts_of_the_machine(spark):
    names = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    found = scanned(spark, [(TEXTS / name).read_text() for name in names])
    assert [name for name, _ in found] == list(names.values())

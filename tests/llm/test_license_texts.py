"""License texts, wrapped headers, titles and SPDX tags."""

from odgraph.llm import licenses, licensetexts

GPL = """/* This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 */
int main() { return 0; }"""
APACHE = """# Copyright 2019 The Frob Authors
#
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.
import os"""


def _files():
    texts = licensetexts.texts()
    mit = texts["MIT"]
    return [
        ("a/LICENSE", "MIT License\n\nCopyright (c) 2020 Some One\n\n" + mit, "MIT"),
        ("b/LICENSE", mit.split("\n\n")[0], "MIT"),
        ("c/COPYING", texts["GPL-3.0"], "GPL-3.0"),
        ("d/COPYING", texts["GPL-2.0"], "GPL-2.0"),
        ("e/LICENSE", texts["Apache-2.0"], "Apache-2.0"),
        ("f/LICENSE", "Copyright (c) 2020, Some One\nAll rights reserved.\n\n" + texts["BSD-3-Clause"], "BSD-3-Clause"),
        ("g/LICENSE", "Copyright (c) 2020, Some One\nAll rights reserved.\n\n" + texts["BSD-2-Clause"], "BSD-2-Clause"),
        ("h/COPYING", texts["AGPL-3.0"], "AGPL-3.0"),
        ("i/x.c", GPL, "GPL-3.0"),
        ("j/x.py", APACHE, "Apache-2.0"),
        ("k/x.py", "x = 1\n# SPDX-License-Identifier: MIT\ny = 2", "MIT"),
        ("l/x.py", "# SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0"),
        ("m/README", "Frob\n\nISC License\n", "ISC"),
        ("n/README", "GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007\n", "GPL-3.0"),
        ("o/README", "Apache License", "Apache-2.0"),
        ("p/README", "GNU GENERAL PUBLIC LICENSE", "GPL-1.0-or-later"),
        ("q/x.txt", "Copyright (c) 2020 Some One and Others. All rights reserved.", "LicenseRef-All-Rights-Reserved"),
        ("r/x.txt", "mit\ngnu\napache", None),
        ("s/x.txt", "She granted him permission to use the software; the license of the house is of no merit.", None),
        ("t/x.txt", "# SPDX-License-Identifier: Zlib", None),
        ("a/sub/y.py", "code", None),
    ]


def test_texts_headers_titles_and_tags_state_their_license(spark):
    files = _files()
    df = spark.createDataFrame([f[:2] for f in files], "path string, text string")
    got = {r.path: r for r in licenses.scan_licenses(df).collect()}
    assert {p: got[p].own_license for p, _, _ in files} == {p: n for p, _, n in files}
    assert (got["a/sub/y.py"].license, got["a/sub/y.py"].inherited_from) == ("MIT", "a")


def test_the_filters_pass_every_match():
    """The heavy terms that a unit may lack leave less than the threshold."""
    for name, v in licenses.Weights(licensetexts.long_templates(), stop=licensetexts.STOP).vectors.items():
        heavy, n = licenses._needed(v, licenses.THRESHOLD)
        kept = set(v) - set(heavy) | set(heavy[:n - 1])
        assert sum(v[t] ** 2 for t in kept) < licenses.THRESHOLD ** 2, name


def test_texts_are_found_inside_a_zip(tmp_path):
    import pathlib
    import subprocess
    import sys
    import zipfile

    import odgraph

    root = pathlib.Path(odgraph.__file__).parent
    with zipfile.ZipFile(tmp_path / "odgraph.zip", "w") as z:
        for f in root.rglob("*"):
            if f.suffix in (".py", ".txt"):
                z.write(f, f.relative_to(root.parent))
    code = "from odgraph.llm import licensetexts; t = licensetexts.texts(); assert 'AGPL-3.0' in t, t"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path, env={"PYTHONPATH": str(tmp_path / "odgraph.zip")})

"""License texts, headers of several lines, titles and SPDX tags.

A template is named ``id`` or ``id/form``.  Texts are read by the driver from
``license_texts``; AGPL-3.0 is GPL-3.0 with its own name put in, BSD-2-Clause
is BSD-3-Clause without its third condition.  EPL-2.0 and the CC BY family
have titles and tags but no text here.
"""

from __future__ import annotations

import re
from importlib import resources

#: Words of any English text; they weigh nothing in long templates.
STOP = frozenset("""a all an and any are as at be but by do for from has have if in into is it its may no not of on or
other such than that the their then there this to under up we which with you your""".split())

_GNU = """This {kind} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as
published by the Free Software Foundation, either version {v} of the License, or (at your option) any later version.
"""
_GNU_REST = """This {kind} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details. You should
have received a copy of the GNU {name} along with this {kind}. If not, see https://www.gnu.org/licenses/."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
"""
_APACHE_REST = """Unless required by applicable law or agreed to in writing, software distributed under the License is
distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License
for the specific language governing permissions and limitations under the License."""

_GNU_NAMES = (("AGPL-3.0", "program", "Affero General Public License", "3"),
              ("GPL-2.0", "program", "General Public License", "2"),
              ("GPL-3.0", "program", "General Public License", "3"),
              ("LGPL-2.1", "library", "Lesser General Public License", "2.1"),
              ("LGPL-3.0", "library", "Lesser General Public License", "3"))

#: Titles; those that name no version come last and give way to all else.
TITLES = (
    ("AGPL-3.0", ("GNU Affero General Public License Version 3, 19 November 2007", "GNU Affero General Public License v3.0")),
    ("Apache-2.0", ("Apache License Version 2.0, January 2004", "Apache License Version 2.0", "Apache License 2.0")),
    ("BSD-2-Clause", ("BSD 2-Clause License", "Simplified BSD License")),
    ("BSD-3-Clause", ("BSD 3-Clause License", "New BSD License", "Modified BSD License")),
    ("BSL-1.0", ("Boost Software License Version 1.0 August 17th, 2003", "Boost Software License Version 1.0")),
    ("CC-BY-4.0", ("Creative Commons Attribution 4.0 International Public License",
                   "Creative Commons Attribution 4.0 International")),
    ("CC-BY-NC-4.0", ("Creative Commons Attribution-NonCommercial 4.0 International",)),
    ("CC-BY-NC-ND-4.0", ("Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International",)),
    ("CC-BY-NC-SA-4.0", ("Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International",)),
    ("CC-BY-SA-4.0", ("Creative Commons Attribution-ShareAlike 4.0 International",)),
    ("CC0-1.0", ("CC0 1.0 Universal", "Creative Commons CC0 1.0 Universal")),
    ("EPL-2.0", ("Eclipse Public License v 2.0", "Eclipse Public License Version 2.0")),
    ("GPL-2.0", ("GNU General Public License Version 2, June 1991", "GNU General Public License v2.0")),
    ("GPL-3.0", ("GNU General Public License Version 3, 29 June 2007", "GNU General Public License v3.0")),
    ("ISC", ("ISC License", "The ISC License")),
    ("LGPL-2.1", ("GNU Lesser General Public License Version 2.1, February 1999",)),
    ("LGPL-3.0", ("GNU Lesser General Public License Version 3, 29 June 2007",)),
    ("MIT", ("MIT License", "The MIT License", "The MIT License (MIT)")),
    ("MPL-2.0", ("Mozilla Public License Version 2.0", "Mozilla Public License 2.0")),
    ("Unlicense", ("The Unlicense",)),
)
UNVERSIONED = (
    ("AGPL-3.0", "GNU Affero General Public License"),
    ("Apache-2.0", "Apache License"),
    ("GPL-1.0-or-later", "GNU General Public License"),
    ("LGPL-2.0-or-later", "GNU Lesser General Public License"),
)
RESERVED = "LicenseRef-All-Rights-Reserved"


def texts() -> dict[str, str]:
    """Whole license texts by identifier."""
    root = resources.files("odgraph.llm") / "license_texts"  # also inside a zip
    found = sorted((f for f in root.iterdir() if f.name.endswith(".txt")), key=lambda f: f.name)
    out = {f.name.removesuffix(".txt"): f.read_text() for f in found}
    affero = re.sub(r"(?i)GNU\s+GENERAL\s+PUBLIC\s+LICENSE", "GNU Affero General Public License", out["GPL-3.0"])
    out["AGPL-3.0"] = affero
    out["BSD-2-Clause"] = re.sub(r"(?s)3\. Neither.*?permission\.\n", "", out["BSD-3-Clause"])
    return out


def long_templates() -> list[tuple[str, str]]:
    """Texts, openings of the short ones, and headers in one and all of their parts."""
    out = sorted((f"{name}/text", text) for name, text in texts().items())
    whole = dict(out)
    out += [(f"{n}/opening", whole[f"{n}/text"].split("\n\n")[0]) for n in ("ISC", "MIT")]
    out.append(("BSL-1.0/opening", whole["BSL-1.0/text"].split("\n\n")[1]))
    for id_, kind, name, v in _GNU_NAMES:
        first, rest = (x.format(kind=kind, name=name, v=v) for x in (_GNU, _GNU_REST))
        out += [(f"{id_}/grant", first), (f"{id_}/header", first + rest)]
    out += [("Apache-2.0/grant", _APACHE), ("Apache-2.0/header", _APACHE + _APACHE_REST)]
    out.append(("MPL-2.0/header", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If
a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""))
    out.append(("EPL-2.0/header", """This program and the accompanying materials are made available under the terms of the
Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"""))
    out.append(("BSL-1.0/header", """Distributed under the Boost Software License, Version 1.0. (See accompanying file
LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt)"""))
    return out


def short_templates(ids) -> list[tuple[str, str]]:
    """Titles and SPDX tags; names with ``/bare`` are the weakest."""
    out = [(f"{id_}/title{i}", t) for id_, titles in TITLES for i, t in enumerate(titles)]
    out += [(f"{id_}/bare", t) for id_, t in UNVERSIONED]
    for id_ in ids:
        if id_ == RESERVED:
            continue
        forms = ["", "-only", "-or-later"] if "GPL" in id_ else [""]
        out += [(f"{id_}/spdx{x}", f"SPDX-License-Identifier: {id_}{x}") for x in forms]
    return out

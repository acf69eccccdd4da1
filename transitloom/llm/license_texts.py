"""Licence texts and notices, as published, by SPDX identifier.

Long texts lie in ``licenses``, one file per identifier. Every text is known in the forms it
is distributed in: with and without title, appendix or preamble, list marks of any kind.
"""

from __future__ import annotations

import re
from importlib.resources import files
from itertools import product

_BSD_START = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution.
"""
_BSD_END = """
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
_BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its
contributors may be used to endorse or promote products derived from
this software without specific prior written permission.
"""
_MIT = """MIT License

Copyright (c) <year> <copyright holders>

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.
"""

# Titles that stand over the short texts.
_TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)",
            "MIT", "Expat License", "The Expat License", "MIT License (Expat)"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)", "ISC"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "2-Clause BSD License",
                     "The 2-Clause BSD License", "Simplified BSD License", "The Simplified BSD License",
                     "BSD 2-Clause \"Simplified\" License", "FreeBSD License", "The FreeBSD License",
                     "BSD License", "The BSD License", "BSD 2-Clause", "BSD-2-Clause License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "3-Clause BSD License",
                     "The 3-Clause BSD License", "New BSD License", "The New BSD License",
                     "Revised BSD License", "Modified BSD License", "BSD License", "The BSD License",
                     "BSD 3-Clause \"New\" or \"Revised\" License", "BSD 3-Clause",
                     "BSD-3-Clause License"),
}
_LIST_MARKS = ("123", "abc", ("i", "ii", "iii"), ("", "", ""))  # bullets vanish like no mark
# Names of licences in notices, and what comes before them.
_NAMES = {
    "MIT": ("MIT License", "MIT"),
    "ISC": ("ISC License", "ISC"),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License, Version 2.0 (the \"License\")",
                   "Apache License 2.0", "Apache 2.0 License", "Apache 2.0", "Apache License v2.0"),
    "MPL-1.1": ("Mozilla Public License, version 1.1", "MPL 1.1", "Mozilla Public License 1.1"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "MPL 2.0", "Mozilla Public License 2.0",
                "Mozilla Public License, v. 2.0"),
    **{
        f"{short}-{number}": tuple(
            form.format(long=long, short=short, number=said)
            for said in dict.fromkeys((number, number.removesuffix(".0")))
            for form in ("{long}, version {number}", "{long} v{number}", "{long} {number}",
                         "{short} version {number}", "{short} v{number}", "{short}v{number}",
                         "{short}-{number}")
        )
        for short, long, numbers in (
            ("GPL", "GNU General Public License", ("1.0", "2.0", "3.0")),
            ("LGPL", "GNU Lesser General Public License", ("2.1", "3.0")),
            ("LGPL", "GNU Library General Public License", ("2.0",)),
            ("GFDL", "GNU Free Documentation License", ("1.2", "1.3")),
        )
        for number in numbers
    },
    **{
        f"CC-{short}-4.0": (
            f"CC {short} 4.0", f"CC-{short}-4.0", f"Creative Commons {long} 4.0 International License",
            f"Creative Commons {long} 4.0 International", f"Creative Commons {long} 4.0 License",
        )
        for short, long in (
            ("BY", "Attribution"),
            ("BY-SA", "Attribution-ShareAlike"),
            ("BY-NC", "Attribution-NonCommercial"),
            ("BY-ND", "Attribution-NoDerivatives"),
            ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
            ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
        )
    },
    "CC0-1.0": ("CC0 1.0", "CC0", "CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal"),
}
_LEADS = tuple(
    f"{subject}{verb} under {the}"
    for subject, verb, the in product(
        ("", *(f"this {what} is " for what in ("work", "file", "project", "software", "program", "code"))),
        ("licensed", "released", "distributed"),
        ("", "the ", "the terms of the "),
    )
)


def _short_texts() -> list[tuple[str, str]]:
    """Every form of the texts that are kept here."""
    mit = _MIT.removeprefix("MIT License\n\n")
    bare = {
        "MIT": [mit, mit.replace("permission notice shall", "permission notice (including the "
                                 "next paragraph) shall")],
        "ISC": [_ISC, _ISC.replace("and/or distribute", "and distribute")],
        "BSD-2-Clause": [_BSD_START + _BSD_END],
        "BSD-3-Clause": [
            _BSD_START + _BSD_THIRD + _BSD_END,
            # As the University of California publishes it.
            _BSD_START + _BSD_THIRD.replace("copyright holder", "University")
            + _BSD_END.replace("COPYRIGHT HOLDERS", "REGENTS").replace("COPYRIGHT HOLDER", "REGENTS"),
        ],
    }
    found = [("MIT", _MIT)]
    for name, forms in bare.items():
        marks = _LIST_MARKS if name.startswith("BSD") else _LIST_MARKS[:1]
        for form, signs, title in product(forms, marks, ("", *_TITLES[name])):
            marked = re.sub(
                r"(?m)^([123])\. ", lambda at, signs=signs: f"{signs[int(at[1]) - 1]} ", form
            )
            found.append((name, f"{title}\n\n{marked}"))
    return found


def _without(text: str, start: str, end: str) -> str:
    """``text`` without what two patterns enclose, the second one excluded."""
    return re.sub(f"(?s){start}.*?(?={end})", "", text, count=1)


def _long_texts() -> list[tuple[str, str]]:
    """The texts in files, whole and without title, preamble or appendix."""
    found = []
    for file in sorted(files(__package__).joinpath("licenses").iterdir(), key=lambda file: file.name):
        if not file.name.endswith(".txt"):
            continue
        name, text = file.name.removesuffix(".txt"), file.read_text(encoding="utf-8")
        forms = [text]
        # What tells how to apply a licence is no part of it and often left out.
        ends = re.search(r"(?m)^ *END OF TERMS AND CONDITIONS\s*$", text)
        if ends:
            forms += [text[: ends.end()], text[: ends.start()]]
        elif name.startswith("GFDL"):
            forms.append(re.split(r"(?m)^ADDENDUM: ", text)[0])
        elif name.startswith("MPL"):
            forms.append(re.split(r"(?m)^EXHIBIT A|^Exhibit A", text)[0])
        elif name.startswith("CC0"):
            forms.append(text.replace("Creative Commons Legal Code", "", 1))
            # Without the notice of the publisher, too.
            notice = (r"CREATIVE COMMONS CORPORATION IS NOT", r"Statement of Purpose")
            forms += [_without(form, *notice) for form in tuple(forms)]
        # Without its title, which ends where the copyright line or the first heading begins.
        starts = r"(?m)^ *(?:Copyright \(C\)|TERMS AND CONDITIONS FOR|Statement of Purpose|"
        starts += r"CREATIVE COMMONS CORPORATION|1\. Definitions|\s+Preamble)"
        for form in tuple(forms):
            first = re.search(starts, form)
            if first:
                forms.append(form[first.start() :])
        # The same text has been published under several addresses.
        place = r"51\s+Franklin\s+St(?:reet)?,\s+Fifth\s+Floor,\s+Boston,\s+MA\s+02110-1301,?\s+USA"
        places = (
            "59 Temple Place, Suite 330, Boston, MA 02111-1307 USA",
            "675 Mass Ave, Cambridge, MA 02139, USA",
        )
        forms += [re.sub(place, other, form) for form in forms for other in places]
        forms += [form.replace("https://", "http://") for form in forms]
        forms += [form.replace("http://", "https://") for form in forms]
        found += [(name, form) for form in dict.fromkeys(forms)]
    return found


def _notices() -> list[tuple[str, str]]:
    """One-line notices: a lead and a name, or an SPDX tag."""
    found = [
        (name, f"{lead}{said}.")
        for name, names in _NAMES.items()
        for said in names
        for lead in _LEADS
    ]
    for name in _NAMES:
        copyleft = name.split("-")[0] in ("GPL", "LGPL", "GFDL")
        for suffix in ("", "-only", "-or-later", "+") if copyleft else ("",):
            found.append((name, f"SPDX-License-Identifier: {name}{suffix}"))
    return found


KNOWN_TEXTS = (
    *_short_texts(),
    *_long_texts(),
    *_notices(),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
)

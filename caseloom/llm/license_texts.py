"""Public licence texts, standard headers and notices; copyright lines are left out of every digest.

The whole texts in ``license_data`` are as published, one file per licence id.
Query and SQL both take ``LICENSES``. README.md says which licences are known.
"""

import re
from importlib.resources import files

_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_ISC_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""

#: licence id: its notices and short texts
_SHORT: dict[str, list[str]] = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "This project is licensed under the Apache License, Version 2.0.",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        f"""Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

{_WARRANTY}""",
    ],
    "ISC": [
        f"""Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

{_ISC_WARRANTY}"""
    ],
    "0BSD": [
        f"""Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted.

{_ISC_WARRANTY}"""
    ],
}

#: ids of the whole texts
_WHOLE = [
    "Apache-2.0", "Artistic-1.0-Perl", "BSD-3-Clause", "CC0-1.0", "GFDL-1.2", "GFDL-1.3", "GPL-1.0", "GPL-2.0", "GPL-3.0",
    "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "MPL-1.1", "MPL-2.0",
]
#: how the part begins that tells how to apply a licence; many copies end before it
_HOW_TO = r"\n *(?:APPENDIX: How to apply|Appendix: How to Apply|How to Apply These Terms|ADDENDUM: How to use)"
#: a notice of who holds the copyright, which the digest leaves out where it has a line of its own
_HOLDER = r"[^\w\n]*(?:copyright +\(c\)|copyright +[\[<\d]|\(c\)|all rights reserved)"
#: licence id: first and last words of the header for source files in its whole text
_HEADERS = {
    "Apache-2.0": ('Licensed under the Apache License, Version 2.0 (the "License");', "limitations under the License."),
    "GPL-1.0": ("This program is free software; you can redistribute", "02110-1301 USA"),
    "GPL-2.0": ("This program is free software; you can redistribute", "02110-1301 USA."),
    "GPL-3.0": ("This program is free software: you can redistribute", "<https://www.gnu.org/licenses/>."),
    "LGPL-2.0": ("This library is free software; you can redistribute", "02110-1301  USA"),
    "LGPL-2.1": ("This library is free software; you can redistribute", "02110-1301  USA"),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public", "http://mozilla.org/MPL/2.0/."),
}


def _header(text: str, first: str, last: str) -> str:
    start = text.index(first)
    return text[start : text.index(last, start) + len(last)]


def _bsd(regents: str) -> dict[str, list[str]]:
    """The BSD licences of any holder, with three clauses and with two, numbered and not, out of the one of the Regents."""
    regents = regents[regents.index("Redistribution") :]
    three = regents.replace("the University", "the copyright holder").replace("REGENTS AND", "COPYRIGHT HOLDERS AND")
    three = three.replace("REGENTS OR", "COPYRIGHT HOLDER OR")
    two = re.sub(r"\n3\. .*?\n\n", "\n\n", three, flags=re.DOTALL)
    plain = lambda texts: [t for x in texts for t in (x, re.sub(r"(?m)^\d\. ", "* ", x))]
    return {"BSD-3-Clause": plain([regents, three]), "BSD-2-Clause": plain([two])}


def _layouts(text: str) -> list[str]:
    """A text as it is and with each paragraph in one line, as "copyright" at the start of a line takes that line out; with both forms of its addresses."""
    lines = [x for x in text.split("\n") if not re.match(_HOLDER, x, re.IGNORECASE)]
    joined = re.sub(r"(?<!\n)\n(?!\n)", " ", "\n".join(x.strip() for x in lines))
    found = [text, joined.strip()]
    return [v for x in found for v in (x, x.replace("https://", "http://"), x.replace("http://", "https://"))]


def _known() -> dict[str, list[str]]:
    found = {name: list(texts) for name, texts in _SHORT.items()}
    whole = {n: files("caseloom.llm").joinpath("license_data", f"{n}.txt").read_text("utf-8").strip() for n in _WHOLE}
    for name, text in whole.items():
        found.setdefault(name, []).extend([text, re.split(_HOW_TO, text)[0].strip()])
        if name in _HEADERS:
            found[name].append(_header(text, *_HEADERS[name]))
    found["LGPL-3.0"].append(_header(whole["GPL-3.0"], *_HEADERS["GPL-3.0"]).replace("GNU General", "GNU Lesser General"))
    for name, texts in _bsd(whole["BSD-3-Clause"]).items():
        found.setdefault(name, []).extend(texts)
    return {name: list(dict.fromkeys(v for t in texts for v in _layouts(t))) for name, texts in found.items()}


#: licence id: the texts that state it, each matched as a whole
LICENSES: dict[str, list[str]] = _known()

#: equivalent spellings, as patterns over lower-case words parted by single spaces; both sides of a comparison go through all
SPELLINGS: list[tuple[str, str]] = [
    (r"licenc", "licens"),
    (r"\b(sub|non|per) (licens|commercial|infring|cent)", "$1$2"),
    (r"(\w{3})is(e|ed|es|ing|ation|ations)\b", "$1iz$2"),
    (r"(\w{3})our(s|ed|able|ite)?\b", "$1or$2"),
    (r"(\w{3})ll(ed|ing)\b", "$1l$2"),
    (r"\b(fulfi|wilfu)ll?", "$1l"),
    (r"\b(acknowledg|judg)ement", "$1ment"),
    (r"\b(catalog|analog)ue\b", "$1"),
    (r"\bcentre\b", "center"),
    (r"\bprogramme\b", "program"),
    (r"\bartefact", "artifact"),
    (r"\bpractise", "practice"),
    (r"\boffence", "offense"),
    (r"\bwhilst\b", "while"),
    (r"\bcopyright owner", "copyright holder"),
]

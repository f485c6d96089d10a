"""Wordings of common licenses by SPDX identifier: full texts, file headers and short forms.

Full texts lie in ``license_texts`` (public texts, verbatim, read from wherever the package is, a zip
included); one with an appendix ("How to apply") is there with and without it. A
full text alone doesn't say whether later versions are allowed, so it counts as the identifier with -only.
Short forms begin at "under" ("under the terms of the GNU LGPL v3 or later"), whatever verb stands before, but
names alone ("under MIT") need one of a few verbs.
"""

from __future__ import annotations

from importlib.resources import files
from itertools import product

_TEXTS = {
    "Apache-2.0": "Apache-2.0", "GPL-1": "GPL-1.0-only", "GPL-2": "GPL-2.0-only", "GPL-3": "GPL-3.0-only",
    "LGPL-2": "LGPL-2.0-only", "LGPL-2.1": "LGPL-2.1-only", "LGPL-3": "LGPL-3.0-only", "MPL-1.1": "MPL-1.1",
    "MPL-2.0": "MPL-2.0", "GFDL-1.2": "GFDL-1.2-only", "GFDL-1.3": "GFDL-1.3-only", "CC0-1.0": "CC0-1.0",
    "Artistic": "Artistic-1.0-Perl",
}
_END = "END OF TERMS AND CONDITIONS"


def _full_texts():
    for name, license_id in _TEXTS.items():
        try:
            text = (files(__package__) / "license_texts" / f"{name}.txt").read_text(encoding="utf-8")
        except OSError as error:
            raise ImportError(f"the text of {license_id} is not part of this installation") from error
        yield license_id, text
        if _END in text:
            yield license_id, text[: text.index(_END)]


_ISC_DISCLAIMER = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
    "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
    "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
    "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
    "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)


def _gnu(license_id: str, name: str, version: str):
    """File headers of a version of a GNU license, for programs and libraries."""
    for thing, mark in product(("program", "library"), ",;"):
        head = f"This {thing} is free software: you can redistribute it and/or modify it under the terms of the {name}"
        yield f"{license_id}-or-later", (
            f"{head} as published by the Free Software Foundation{mark} either version {version} of the License, or "
            "(at your option) any later version."
        )
    for thing in ("program", "library"):
        head = f"This {thing} is free software: you can redistribute it and/or modify it under the terms of the {name}"
        yield f"{license_id}-only", f"{head} as published by the Free Software Foundation; version {version} of the License."
        yield f"{license_id}-only", f"{head} version {version} as published by the Free Software Foundation."
        yield f"{license_id}-only", (
            f"{head} as published by the Free Software Foundation; version {version} of the License only."
        )


_GNU = (
    ("GPL-1.0", "GNU General Public License", "1"),
    ("GPL-2.0", "GNU General Public License", "2"),
    ("GPL-3.0", "GNU General Public License", "3"),
    ("LGPL-2.0", "GNU Library General Public License", "2"),
    ("LGPL-2.1", "GNU Lesser General Public License", "2.1"),
    ("LGPL-3.0", "GNU Lesser General Public License", "3"),
    ("AGPL-3.0", "GNU Affero General Public License", "3"),
)

_HEADERS = (
    (
        "EPL-1.0",
        "All rights reserved. This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License v1.0 which accompanies this distribution, and is available at "
        "http://www.eclipse.org/legal/epl-v10.html",
    ),
    (
        "EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    ),
    (
        "MPL-1.1",
        "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not "
        "use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.mozilla.org/MPL/",
    ),
    (
        "BSL-1.0",
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at "
        "http://www.boost.org/LICENSE_1_0.txt)",
    ),
    (
        "BSL-1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
        "and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, "
        "distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to "
        "permit third-parties to whom the Software is furnished to do so, all subject to the following:",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software. Permission is granted to anyone to use "
        "this software for any purpose, including commercial applications, and to alter it and redistribute it "
        "freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; "
        "you must not claim that you wrote the original software. If you use this software in a product, an "
        "acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source "
        "versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. "
        "This notice may not be removed or altered from any source distribution.",
    ),
    (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        f"hereby granted. {_ISC_DISCLAIMER}",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        f"{_ISC_DISCLAIMER}",
    ),
    (
        "OFL-1.1",
        "This Font Software is licensed under the SIL Open Font License, Version 1.1. This license is copied below, "
        "and is also available with a FAQ at: https://scripts.sil.org/OFL",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
        "binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    (
        "GFDL-1.3-or-later",
        "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free "
        "Documentation License, Version 1.3 or any later version published by the Free Software Foundation;",
    ),
    (
        "GFDL-1.2-or-later",
        "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free "
        "Documentation License, Version 1.2 or any later version published by the Free Software Foundation;",
    ),
)

#: Names that need no version.
_NAMED = (
    ("MIT", "MIT"), ("MIT", "Expat"), ("ISC", "ISC"), ("Zlib", "zlib"), ("0BSD", "0BSD"), ("0BSD", "Zero-Clause BSD"),
    ("BSD-2-Clause", "BSD 2-Clause"), ("BSD-2-Clause", "2-Clause BSD"), ("BSD-2-Clause", "Simplified BSD"),
    ("BSD-2-Clause", "FreeBSD"), ("BSD-3-Clause", "BSD 3-Clause"), ("BSD-3-Clause", "3-Clause BSD"),
    ("BSD-3-Clause", "New BSD"), ("BSD-3-Clause", "Modified BSD"), ("Unlicense", "Unlicense"), ("WTFPL", "WTFPL"),
)
_BARE = {license_id: {n for i, n in _NAMED if i == license_id} for license_id, _ in _NAMED}
_VERBS = ("licensed", "released", "distributed", "available", "published")
#: Names with the versions they have; the identifier is the first part and the version.
_VERSIONED = (
    ("Apache-", ("Apache", "Apache Software"), ("2.0", "2", "1.1")),
    ("MPL-", ("Mozilla Public", "MPL"), ("2.0", "1.1")),
    ("EPL-", ("Eclipse Public", "EPL"), ("2.0", "1.0")),
    ("BSL-", ("Boost Software", "Boost"), ("1.0",)),
    ("Artistic-", ("Artistic",), ("2.0", "1.0")),
    ("EUPL-", ("European Union Public", "EUPL"), ("1.2", "1.1")),
    ("CDDL-", ("Common Development and Distribution", "CDDL"), ("1.0", "1.1")),
    ("OFL-", ("SIL Open Font", "OFL"), ("1.1",)),
    ("CC0-", ("CC0", "Creative Commons Zero"), ("1.0",)),
)
_CC_VERSIONS = ("4.0", "3.0", "2.5", "2.0", "1.0")
_CC_KINDS = (
    ("BY", "Attribution"), ("BY-NC", "Attribution-NonCommercial"), ("BY-SA", "Attribution-ShareAlike"),
    ("BY-ND", "Attribution-NoDerivatives"), ("BY-ND", "Attribution-NoDerivs"),
    ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
    ("BY-NC-ND", "Attribution-NonCommercial-NoDerivs"),
)
_LATER = ("or later", "or any later version", "or (at your option) any later version")


def _names():
    """Identifiers and what stands after "under" and its article."""
    for license_id, name in _NAMED:
        yield from ((license_id, name), (license_id, f"{name} License"))
    for start, names, versions in _VERSIONED:
        for name, version, word in product(names, versions, ("", "Version ", "v. ", "v")):
            license_id = start + (version if "." in version else f"{version}.0")
            for full in (name, f"{name} License"):
                yield license_id, f"{full} {word}{version}"
    for license_id, long, version in _GNU:
        short = license_id.split("-")[0]
        numbers = {version, version if "." in version else f"{version}.0"}
        for name, word, number in product((long, f"GNU {short}", short), ("", "version ", "v. ", "v"), sorted(numbers)):
            said = f"{name} {word}{number}"
            if name.endswith("Library General Public License") or short != "LGPL" or version != "2":
                yield f"{license_id}-only", said
                yield f"{license_id}-only", f"{said} only"
                yield from ((f"{license_id}-or-later", f"{said} {later}") for later in (*_LATER, "+"))
        if version != "2" or short != "LGPL":
            for number in sorted(numbers):
                said = f"{short}v{number}"
                yield from ((f"{license_id}-only", x) for x in (said, f"GNU {said}"))
                yield from ((f"{license_id}-or-later", f"{said} {later}") for later in (*_LATER, "+"))
    for (kind, name), version in product(_CC_KINDS, _CC_VERSIONS):
        license_id = f"CC-{kind}-{version}"
        yield from ((license_id, f"CC {kind} {version}"), (license_id, f"CC {kind} {version} License"))
        for region in ("", " International", " Unported", " Generic"):
            yield license_id, f"Creative Commons {name} {version}{region}"
            yield license_id, f"Creative Commons {name} {version}{region} License"


def _short_forms():
    for (license_id, name), article in product(_names(), ("", "a ", "the ", "the terms of the ")):
        text = f"under {article}{name}".replace(" +", "+")
        if license_id in _BARE and name in _BARE[license_id]:  # a name alone is no license ("under MIT")
            yield from ((license_id, f"{verb} {text}") for verb in _VERBS)
        elif len(text.split()) > 2:
            yield license_id, text
        else:
            yield from ((license_id, f"{verb} {text}") for verb in _VERBS)


def _both():
    yield from _full_texts()
    for row in _GNU:
        yield from _gnu(*row)
    yield from _HEADERS
    yield from _short_forms()


WORDINGS = tuple(dict.fromkeys(_both()))

"""Templates of the licence scan: (SPDX identifier, wording, identifying phrases).

A phrase is a run of words that must stand unbroken in the matched span; one
with a leading ``!`` must not stand in it or in the ``BEHIND`` words after it.
The whole texts are in ``license_texts``; the AGPL's is the GPL's under its own
name, which differs from it in one section.  An opening that several licences
share has a LicenseRef name.
"""

from __future__ import annotations

import pkgutil


def _text(name: str) -> str:
    return pkgutil.get_data("rewardseg.llm", f"license_texts/{name}.txt").decode()


_NO_LATER = ("!any later version", "!or later", "!or newer")
_AS_IS = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
          "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
          "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
          "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction")
_MIT_RIGHTS = (", including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or "
               "sell copies of the Software, and to permit persons to whom the Software is furnished to do so")
_MIT_TERMS = (", subject to the following conditions: The above copyright notice and this permission notice shall be included in "
              "all copies or substantial portions of the Software. ")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met")
_BSD_TERMS = (": 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
              "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
              "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. ")
_BSD_ADVERT = ("3. All advertising materials mentioning features or use of this software must display the following "
               "acknowledgement: This product includes software developed by the organization. ")
_BSD_NAMES = ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
              "products derived from this software without specific prior written permission. ")
_BSD_AS_IS = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
              "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
              "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, "
              "INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT "
              "OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON "
              "ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
              "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_TERMS = ", provided that the above copyright notice and this permission notice appear in all copies. "
_ISC_AS_IS = ("THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING "
              "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
              "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
              "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
              "USE OR PERFORMANCE OF THIS SOFTWARE.")
_APACHE = "Licensed under the Apache License, Version 2.0"

_SHORT = (
    ("Apache-2.0", _APACHE, ("apache license version 2 0",)),
    ("Apache-2.0", _APACHE + " (the \"License\"); you may not use this file except in compliance with the License. You may obtain "
     "a copy of the License at", ("apache license version 2 0",)),
    ("MIT", "Released under the MIT License", ("mit license",)),
    ("MIT", _MIT, ()),
    ("MIT", "Licensed under the MIT License", ("mit license",)),
    ("MIT", _MIT + _MIT_RIGHTS + _MIT_TERMS + _AS_IS, ("the above copyright notice",)),
    ("MIT-0", _MIT + _MIT_RIGHTS + ". " + _AS_IS, ("!the above copyright notice",)),
    ("X11", _MIT + _MIT_RIGHTS + _MIT_TERMS + _AS_IS + " Except as contained in this notice, the name of the copyright holder "
     "shall not be used in advertising or otherwise to promote the sale, use or other dealings in this Software without prior "
     "written authorization from the copyright holder.", ("except as contained in this notice",)),
    ("Apache-2.0", _APACHE + " (the \"License\"); you may not use this file except in compliance with the License. You may obtain "
     "a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
     "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF "
     "ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under "
     "the License.", ("apache license version 2 0",)),
    ("Apache-1.1", "Licensed under the Apache License, Version 1.1", ("apache license version 1 1",)),
    ("Apache-1.1", "Licensed under the Apache Software License, Version 1.1", ("apache software license version 1 1",)),
    ("LicenseRef-BSD", _BSD, ()),
    ("BSD-2-Clause", _BSD + _BSD_TERMS + _BSD_AS_IS, ("!endorse or promote products", "!all advertising materials")),
    ("BSD-3-Clause", _BSD + _BSD_TERMS + "3. " + _BSD_NAMES + _BSD_AS_IS, ("endorse or promote products", "!all advertising materials")),
    ("BSD-4-Clause", _BSD + _BSD_TERMS + _BSD_ADVERT + "4. " + _BSD_NAMES + _BSD_AS_IS,
     ("endorse or promote products", "all advertising materials")),
    *[(f"BSD-{n}-Clause", f"Licensed under the {name} License", (f"{name.replace('-', ' ').lower()} license",))
      for n, word in ((2, "Simplified"), (3, "New")) for name in (f"BSD {n}-Clause", f"{n}-Clause BSD", f"{word} BSD")],
    ("LicenseRef-ISC-or-0BSD", _ISC, ()),
    ("ISC", _ISC + _ISC_TERMS, ("the above copyright notice",)),
    ("ISC", _ISC + _ISC_TERMS + _ISC_AS_IS, ("the above copyright notice",)),
    ("ISC", "Licensed under the ISC License", ("isc license",)),
    ("0BSD", _ISC + ". " + _ISC_AS_IS, ("!the above copyright notice",)),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
     ("mozilla public license v 2 0",)),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
     "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.", ("mozilla public license v 2 0",)),
    *[(f"MPL-{v}", f"The contents of this file are subject to the Mozilla Public License Version {v} (the \"License\"); you may not "
       "use this file except in compliance with the License.", ("mozilla public license version " + v.replace(".", " "),))
      for v in ("1.0", "1.1")],
    *[(f"MPL-{v}", f"Licensed under the Mozilla Public License, {w} {v}", (f"mozilla public license {w} {v.replace('.', ' ')}",))
      for v in ("1.0", "1.1", "2.0") for w in ("version", "v")],
    *[(f"EPL-{v}", f"{start} the {'terms of the ' if start != 'Licensed under' else ''}Eclipse Public License {w} {v}",
       (" ".join(f"eclipse public license {w} {v}".replace(".", " ").split()),))
      for v in ("1.0", "2.0") for w in ("", "v", "version") for start in (
          "Licensed under", "This program and the accompanying materials are made available under")],
    *[(f"{i}-{v}", f"Licensed under the {name}, Version {v}", (f"{name} version {v}".lower().replace(".", " "),))
      for i, name, versions in (("Artistic", "Artistic License", ("1.0", "2.0")), ("BSL", "Boost Software License", ("1.0",)),
                                ("CDDL", "Common Development and Distribution License", ("1.0", "1.1")),
                                ("EUPL", "European Union Public Licence", ("1.1", "1.2")))
      for v in versions],
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
     "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and "
     "transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is "
     "furnished to do so", ("any person or organization",)),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
     "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any "
     "purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
     "restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original "
     "software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is "
     "not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the "
     "original software. 3. This notice may not be removed or altered from any source distribution.",
     ("altered source versions must be plainly marked",)),
    ("Unlicense", "This is free and unencumbered software released into the public domain.", ("free and unencumbered software",)),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
     "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
     "commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of "
     "this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the "
     "benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt "
     "act of relinquishment in perpetuity of all present and future rights to this software under copyright law. "
     + _AS_IS.replace("AUTHORS OR COPYRIGHT HOLDERS", "AUTHORS"), ("free and unencumbered software",)),
    ("CC0-1.0", "Licensed under CC0 1.0", ("cc0 1 0",)),
    ("CC0-1.0", "This work is licensed under the Creative Commons Zero v1.0 Universal License", ("creative commons zero",)),
    ("CC0-1.0", "http://creativecommons.org/publicdomain/zero/1.0", ("publicdomain zero 1 0",)),
    ("CC0-1.0", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to "
     "this software to the public domain worldwide. This software is distributed without any warranty.",
     ("to the public domain worldwide",)),
    ("WTFPL", "Do What The Fuck You Want To Public License", ("want to public license",)),
)


def _gnu():
    for spdx, name, versions in (("GPL", "GNU General Public License", ("1", "2", "3")),
                                 ("LGPL", "GNU Library General Public License", ("2",)),
                                 ("LGPL", "GNU Lesser General Public License", ("2", "2.1", "3")),
                                 ("AGPL", "GNU Affero General Public License", ("1", "3"))):
        for v in versions:
            known = f"{spdx}-{v if '.' in v else v + '.0'}"
            number = v.replace(".", " ")
            family = (name.lower(), *(("!version 2 1", "!v2 1") if v == "2" else ()))
            only, later = (*family, f"version {number}", *_NO_LATER), (*family, f"version {number}")
            for thing in ("program", "library", "software"):
                head = f"This {thing} is free software; you can redistribute it and/or modify it under the terms of the {name} "
                published = head + "as published by the Free Software Foundation"
                yield f"{known}-or-later", published + (f", either version {v} of the License, or (at your option) any later "
                                                         "version"), (*later, "any later version")
                yield f"{known}-only", published + f", version {v} of the License", only
                yield f"{known}-only", head + f"version {v} as published by the Free Software Foundation", only
            for begin in ("This work is licensed under the", "Licensed under the", "Released under the terms of the"):
                for after, need in ((" or later", "or later"), (" or any later version", "any later version"),
                                    (" or (at your option) any later version", "any later version")):
                    yield f"{known}-or-later", f"{begin} {name}, version {v}{after}", (*later, need)
                yield f"{known}-only", f"{begin} {name}, version {v}", only
                yield f"{known}-only", f"{begin} {name} v{v}", (*family, f"v{number}", *_NO_LATER)
                yield f"{known}-or-later", f"{begin} {name} v{v} or later", (*family, f"v{number}", "or later")


def _creative_commons():
    words = {"BY": "Attribution", "NC": "NonCommercial", "SA": "ShareAlike", "ND": "NoDerivatives"}
    for version, port in (("1.0", "Generic"), ("2.0", "Generic"), ("2.5", "Generic"), ("3.0", "Unported"), ("4.0", "International")):
        for kind in ("BY", "BY-SA", "BY-NC", "BY-NC-SA", "BY-ND", "BY-NC-ND"):
            spdx, number = f"CC-{kind}-{version}", version.replace(".", " ")
            code = f"{kind.lower().replace('-', ' ')} {number}"
            link = f"http://creativecommons.org/licenses/{kind.lower()}/{version}"
            yield spdx, f"Licensed under CC {kind} {version}", (f"cc {code}",)
            yield spdx, f"This work is licensed under CC {kind} {version}", (f"cc {code}",)
            yield spdx, link, (f"org licenses {code}",)
            for derivatives in ("NoDerivatives", "NoDerivs") if "ND" in kind else ("",):
                name = "-".join(derivatives if k == "ND" else words[k] for k in kind.split("-"))
                need = f"commons {name.replace('-', ' ').lower()} {number}"
                for suffix in (port + " License", port + " (CC " + kind + " " + version + ")"):
                    notice = f"This work is licensed under a Creative Commons {name} {version} {suffix}"
                    yield spdx, notice, (need,)
                    yield spdx, notice + f". To view a copy of this license, visit {link}", (need, f"licenses {code}")


def _whole():
    gpl3 = _text("GPL-3").replace("GNU GENERAL PUBLIC", "GNU AFFERO GENERAL PUBLIC").replace("GNU General Public", "GNU Affero General Public")
    yield "Apache-2.0", _text("Apache-2.0"), ("apache license version 2 0",)
    yield "CC0-1.0", _text("CC0-1.0"), ("cc0 1 0 universal",)
    for v in ("1.1", "2.0"):
        yield f"MPL-{v}", _text(f"MPL-{v}"), ("mozilla public license version " + v.replace(".", " "),)
    for v in ("1.2", "1.3"):
        yield f"GFDL-{v}-only", _text(f"GFDL-{v}"), ("gnu free documentation license version " + v.replace(".", " "),)
    for v in ("1", "2", "3"):
        yield f"GPL-{v}.0-only", _text(f"GPL-{v}"), (f"gnu general public license version {v}",)
    yield "LGPL-2.0-only", _text("LGPL-2"), ("gnu library general public license",)
    yield "LGPL-2.1-only", _text("LGPL-2.1"), ("gnu lesser general public license version 2 1",)
    yield "LGPL-3.0-only", _text("LGPL-3"), ("gnu lesser general public license version 3",)
    yield "AGPL-3.0-only", gpl3, ("gnu affero general public license version 3",)


TEMPLATES = tuple(dict.fromkeys((*_SHORT, *_gnu(), *_creative_commons(), *_whole())))

"""Texts of common licences and notices, fixed values from their publishers: (name, text).

Whole licences lie in ``licence_files``; one-line notices are the usual phrases with the usual names of each licence.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from pathlib import Path

WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
    "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so"
)
MIT = (
    f"{GRANT}, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be "
    f"included in all copies or substantial portions of the Software.\n\n{WARRANTY}"
)
ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
ISC_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE."
)
ISC = f"{ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies.\n\n{ISC_WARRANTY}"
BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:\n\n"
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer.\n\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution.\n\n"
)
BSD_NAME = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.\n\n"
)
BSD_TAIL = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
    "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
    "liable for any damages arising from the use of this software.\n\n"
    "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter "
    "it and redistribute it freely, subject to the following restrictions:\n\n"
    "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If "
    "you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not "
    "required.\n"
    "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original "
    "software.\n"
    "3. This notice may not be removed or altered from any source distribution."
)
APACHE_NOTICE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
    "the License. You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\n"
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
    '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific '
    "language governing permissions and limitations under the License."
)
UNLICENSE = (
    "This is free and unencumbered software released into the public domain.\n\n"
    "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or "
    "as a compiled binary, for any purpose, commercial or non-commercial, and by any means.\n\n"
    "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright "
    "interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the "
    "detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of "
    "all present and future rights to this software under copyright law.\n\n"
    + WARRANTY.replace("AUTHORS OR COPYRIGHT HOLDERS", "AUTHORS")
    + "\n\nFor more information, please refer to <http://unlicense.org/>"
)
GPL3_NOTICE = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
    "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
    "version.\n\nThis program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
    "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
    "details.\n\nYou should have received a copy of the GNU General Public License along with this program. If not, see "
    "<https://www.gnu.org/licenses/>."
)

KNOWN = [
    ("MIT", MIT),
    ("MIT", f"MIT License\n\n{MIT}"),
    ("MIT", f"The MIT License (MIT)\n\n{MIT}"),
    ("MIT-0", f"{GRANT}.\n\n{WARRANTY}"),
    ("MIT-0", f"MIT No Attribution\n\n{GRANT}.\n\n{WARRANTY}"),
    ("ISC", ISC),
    ("ISC", f"ISC License\n\n{ISC}"),
    ("0BSD", f"{ISC_GRANT}.\n\n{ISC_WARRANTY}"),
    ("BSD-2-Clause", BSD_HEAD + BSD_TAIL),
    ("BSD-2-Clause", "BSD 2-Clause License\n\n" + BSD_HEAD + BSD_TAIL),
    ("BSD-3-Clause", BSD_HEAD + BSD_NAME + BSD_TAIL),
    ("BSD-3-Clause", "BSD 3-Clause License\n\n" + BSD_HEAD + BSD_NAME + BSD_TAIL),
    ("Zlib", ZLIB),
    ("Zlib", f"zlib License\n\n{ZLIB}"),
    ("Unlicense", UNLICENSE),
    ("Apache-2.0", APACHE_NOTICE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("GPL-3.0", GPL3_NOTICE),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-3.0-or-later", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0-only"),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
]

#: Whole licences as published, one file a licence.
FILES = Path(__file__).with_name("licence_files")
APPENDIX = "END OF TERMS AND CONDITIONS"
#: The publisher's address in the editions of the GNU licences.
ADDRESSES = [
    "51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA", "51 Franklin St, Fifth Floor, Boston, MA 02110-1301 USA",
    "59 Temple Place, Suite 330, Boston, MA 02111-1307 USA", "675 Mass Ave, Cambridge, MA 02139, USA", "<https://fsf.org/>",
]
WRITTEN_ADDRESS = re.compile(r"51 Franklin St(reet)?, Fifth Floor, Boston,? MA\s+02110-1301\s+USA")

CC = {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial",
    "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
#: Versions with what publishers put behind them.
CC_VERSIONS = {"1.0": " Generic", "2.0": " Generic", "2.5": " Generic", "3.0": " Unported", "4.0": " International"}
GNU = {
    "GPL": ("General Public License", ("1.0", "2.0", "3.0")),
    "LGPL": ("Lesser General Public License", ("2.0", "2.1", "3.0")),
    "AGPL": ("Affero General Public License", ("3.0",)),
    "GFDL": ("Free Documentation License", ("1.1", "1.2", "1.3")),
}
#: Other licences as notices name them; a name that ends in License stands without that word too.
NAMES = {
    "MIT": ["MIT License", "MIT/X11 License", "Expat License"],
    "MIT-0": ["MIT-0 License", "MIT No Attribution License"],
    "ISC": ["ISC License"],
    "0BSD": ["0BSD License", "Zero-Clause BSD License"],
    "BSD": ["BSD License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License", "FreeBSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License", "Revised BSD License"],
    "Zlib": ["zlib License", "zlib/libpng License"],
    "Unlicense": ["Unlicense"],
    "WTFPL": ["WTFPL"],
    "BSL-1.0": ["BSL-1.0 License", "Boost Software License, Version 1.0", "Boost Software License 1.0"],
    "Apache": ["Apache License", "Apache Software License"],
    "Apache-2.0": [
        "Apache License, Version 2.0", "Apache License, v2.0", "Apache License, v. 2.0", "Apache License 2.0", "Apache License v2",
        "Apache Software License, Version 2.0", "Apache Software License 2.0", "Apache 2.0 License", "Apache-2.0 License",
        "Apache 2 License", "Apache v2 License", "Apache Version 2.0 License", "ASL 2.0",
    ],
    "MPL": ["Mozilla Public License", "MPL"],
    "MPL-1.1": ["Mozilla Public License, Version 1.1", "Mozilla Public License 1.1", "MPL 1.1 License"],
    "MPL-2.0": [
        "Mozilla Public License, Version 2.0", "Mozilla Public License, v. 2.0", "Mozilla Public License v2.0",
        "Mozilla Public License 2.0", "MPL 2.0 License", "MPLv2 License",
    ],
    "EPL-1.0": ["Eclipse Public License, Version 1.0", "Eclipse Public License v1.0", "Eclipse Public License 1.0", "EPL 1.0 License"],
    "EPL-2.0": ["Eclipse Public License, Version 2.0", "Eclipse Public License v2.0", "Eclipse Public License 2.0", "EPL 2.0 License"],
    "Artistic": ["Artistic License"],
    "Artistic-1.0": ["Artistic License 1.0", "Artistic License, Version 1.0"],
    "Artistic-2.0": ["Artistic License 2.0", "Artistic License, Version 2.0"],
    "CC0": ["CC0 License"],
    "CC0-1.0": [
        "CC0 1.0 License", "CC0 1.0 Universal License", "CC0 1.0 Universal Public Domain Dedication License",
        "Creative Commons CC0 1.0 Universal License", "Creative Commons Zero v1.0 Universal License", "Creative Commons Zero License",
    ],
    "PSF-2.0": ["PSF-2.0 License", "Python Software Foundation License Version 2"],
}
PHRASES = [
    "Licensed under", "Released under", "Distributed under", "Available under", "Licensed under the terms of",
    *(f"This {work} is licensed under" for work in ("work", "project", "software", "program", "file")),
    "License:",
]


def _names() -> Iterator[tuple[str, str]]:
    """(licence, a name of it)."""
    for name, written in NAMES.items():
        yield from ((name, w) for w in written)
        yield from ((name, w.removesuffix(" License")) for w in written if w.endswith(" License"))
    for short, words in CC.items():
        for version in ("", *CC_VERSIONS):
            licence = f"CC-{short}-{version}".strip("-")
            for long in dict.fromkeys((words, words.replace("NoDerivatives", "NoDerivs"))):
                named = f"Creative Commons {long} {version}".rstrip()
                yield from ((licence, named + tail) for tail in dict.fromkeys((" License", f"{CC_VERSIONS.get(version, '')} License")))
            yield from ((licence, f"CC {short} {version}".rstrip() + tail) for tail in ("", " License"))
    for short, (words, versions) in GNU.items():
        yield from ((short, name) for name in (f"GNU {words}", f"GNU {short}", short))
        for version in versions:
            for v in dict.fromkeys((version.removesuffix(".0"), version)):
                yield from ((f"{short}-{version}", f"GNU {words}{x}{v}") for x in (", version ", " v", " "))
                yield f"{short}-{version}-or-later", f"GNU {words}, version {v} or later"
                yield f"{short}-{version}-or-later", f"GNU {words}, version {v}, or (at your option) any later version"
                for name in (f"{short} v{v}", f"{short}v{v}", f"{short} {v}"):
                    yield from ((f"{short}-{version}{end.replace(' ', '-')}", f"{name}{end}") for end in ("", " or later", " only"))


def _notices() -> Iterator[tuple[str, str]]:
    """(licence, one line that says so), with the article that the name takes."""
    for licence, name in _names():
        words = "License" in name or name.startswith("GNU") or name == "Unlicense"
        for phrase in PHRASES:
            articles = ("",) if phrase == "License:" else ("a ", "the ") if name.startswith("Creative") else ("the ",) if words else ("", "the ")
            yield from ((licence, f"{phrase} {article}{name}.") for article in articles)
    short = ("MIT", "ISC", "0BSD", "Zlib", "Unlicense", "WTFPL")
    for licence in dict.fromkeys(licence for licence, _ in _names() if licence in short or licence[-1].isdigit() or "-or-" in licence):
        yield licence, f"SPDX-License-Identifier: {licence}"
        if licence.endswith("-or-later"):
            yield licence.replace("or-later", "only"), f"SPDX-License-Identifier: {licence.replace('or-later', 'only')}"


def _whole() -> Iterator[tuple[str, str]]:
    """(licence, text) of the files, with and without what follows the terms, and in the editions by address."""
    for path in sorted(FILES.glob("*.txt")):
        text = path.read_text("utf-8")
        terms = text.split(APPENDIX)[0] + APPENDIX
        for part in dict.fromkeys((text, terms if APPENDIX in text else text)):
            yield path.stem, part
            if WRITTEN_ADDRESS.search(part):
                yield from ((path.stem, WRITTEN_ADDRESS.sub(address, part)) for address in ADDRESSES)


MPL_NOTICE = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
    "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
)


def _headers() -> Iterator[tuple[str, str]]:
    """(licence, the notice that its text asks for at the head of files)."""
    yield "MPL-2.0", MPL_NOTICE
    for short, (words, versions) in GNU.items():
        for version in versions if short != "GFDL" else ():
            own = GPL3_NOTICE.replace("GNU General", f"GNU {words.removesuffix(' Public License')}")
            for v in dict.fromkeys((version.removesuffix(".0"), version)):
                yield f"{short}-{version}", own.replace("version 3", f"version {v}")


def _forms(texts: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """The texts that differ by more than case and marks."""
    seen = {}
    for licence, text in texts:
        seen.setdefault(" ".join(re.findall(r"[^\W_]+", text.lower())), (licence, text))
    return list(seen.values())


KNOWN = _forms([*KNOWN, *_whole(), *_headers(), *_notices()])

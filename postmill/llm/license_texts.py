"""Licence bodies and headers of several lines, with the terms that a block must have to be one.

Short licences are here in full. Of the long ones there are the title, the opening and the header that
the licence asks files to carry; any of them names the licence. Fixed values.
"""

from __future__ import annotations

GRANT_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
    "permit persons to whom the Software is furnished to do so, subject to the following conditions:"
)
REST_MIT = (
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
    'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
    "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
    "THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN "
    "THE SOFTWARE."
)
ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
    "provided that the above copyright notice and this permission notice appear in all copies."
)
REST_ISC = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN "
    "AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE."
)
CLAUSES_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution."
)
ENDORSE_BSD = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission."
)
REST_BSD = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
APACHE_HEADER = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
    "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
    'applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
    "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
    "governing permissions and limitations under the License."
)
UNLICENSE = (
    "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
    "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
    "commercial or non-commercial, and by any means."
)
MPL_HEADER = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
    "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
)
# id, name and version as the texts write it, date of the title
GNU = [
    ("GPL-1.0", "General", "1", "February 1989"),
    ("GPL-2.0", "General", "2", "June 1991"),
    ("GPL-3.0", "General", "3", "29 June 2007"),
    ("LGPL-2.0", "Library General", "2", "June 1991"),
    ("LGPL-2.0", "Lesser General", "2", "June 1991"),
    ("LGPL-2.1", "Lesser General", "2.1", "February 1999"),
    ("LGPL-3.0", "Lesser General", "3", "29 June 2007"),
    ("AGPL-3.0", "Affero General", "3", "29 June 2007"),
]
CREATIVE = {
    "CC-BY-4.0": "Attribution",
    "CC-BY-SA-4.0": "Attribution-ShareAlike",
    "CC-BY-NC-4.0": "Attribution-NonCommercial",
    "CC-BY-ND-4.0": "Attribution-NoDerivatives",
    "CC-BY-NC-SA-4.0": "Attribution-NonCommercial-ShareAlike",
    "CC-BY-NC-ND-4.0": "Attribution-NonCommercial-NoDerivatives",
}

# Titles and sentences, which a line may be as a whole.
TITLES = [
    *[(x, f"GNU {name} Public License Version {version}, {date}") for x, name, version, date in GNU],
    *[(x, f"Creative Commons {name} 4.0 International Public License") for x, name in CREATIVE.items()],
    *[(x, f"This work is licensed under a Creative Commons {name} 4.0 International License.") for x, name in CREATIVE.items()],
    ("LGPL-2.1", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-1.1", "Mozilla Public License Version 1.1"),
    ("Apache-1.1", "Licensed under the Apache License, Version 1.1"),
    ("CC-BY-3.0", "Licensed under CC BY 3.0."),
    ("CC-BY-SA-3.0", "Licensed under CC BY-SA 3.0."),
    ("CC-BY-NC-3.0", "Licensed under CC BY-NC 3.0."),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal"),
]


def _headers() -> list[tuple[str, str, str, str]]:
    out = []
    for licence, name, version, _ in GNU:
        for what in ("program", "library"):
            start = (
                f"This {what} is free software; you can redistribute it and/or modify it under the terms of the GNU {name} "
                "Public License as published by the Free Software Foundation"
            )
            for end in (f"either version {version} of the License, or (at your option) any later version.", f"version {version} of the License."):
                out.append((licence, f"redistribute gnu {name.lower()} public {version}", "", f"{start}; {end}"))
    for licence, name in CREATIVE.items():
        out.append((
            licence, f"exercising creative commons {name.lower()} 4.0", "",
            "By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of "
            f'this Creative Commons {name} 4.0 International Public License ("Public License").',
        ))
    return out


# Licence, terms that a block must have, terms that it must not have, text.
BODIES: list[tuple[str, str, str, str]] = [
    ("MIT", "granted sublicense furnished", "", GRANT_MIT),
    ("MIT", "granted sublicense furnished noninfringement", "", f"{GRANT_MIT} {REST_MIT}"),
    ("ISC", "permission fee granted provided", "", ISC),
    ("ISC", "permission fee granted provided disclaims", "", f"{ISC} {REST_ISC}"),
    ("0BSD", "permission fee granted disclaims", "that appear", f"{ISC[: ISC.index(',' + ' provided')]}. {REST_ISC}"),
    ("BSD-2-Clause", "redistributions retain reproduce exemplary", "endorse advertising", f"{CLAUSES_BSD} {REST_BSD}"),
    ("BSD-3-Clause", "redistributions retain reproduce endorse exemplary", "advertising", f"{CLAUSES_BSD} {ENDORSE_BSD} {REST_BSD}"),
    ("Apache-2.0", "apache version 2.0 compliance conditions", "", APACHE_HEADER),
    ("Unlicense", "unencumbered public domain compile", "", UNLICENSE),
    ("MPL-2.0", "mozilla public 2.0 obtain", "", MPL_HEADER),
    *_headers(),
]

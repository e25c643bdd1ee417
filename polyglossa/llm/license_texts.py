"""License templates: whole texts of short licenses, standard headers of long ones, and notices built from names.

Texts here stand without copyright lines, whose names and years differ. Whole texts of long licenses are the files of
licenses/, unchanged; license_scan.templates_from reads others.
"""

from __future__ import annotations

from importlib.resources import files

# Words by which a work is put under a license, and names of licenses as they follow "under".
VERBS = ("licensed", "released", "distributed", "published", "available", "provided")
NAMES = {
    "mit": ("the MIT License", "an MIT license"),
    "apache-2.0": ("the Apache License, Version 2.0", "the Apache License 2.0", "the Apache 2.0 License"),
    "gpl-2.0": ("the GNU General Public License, version 2", "the GNU General Public License v2.0", "the GNU GPL v2"),
    "gpl-3.0": ("the GNU General Public License, version 3", "the GNU General Public License v3.0", "the GNU GPL v3"),
    "lgpl-2.1": ("the GNU Lesser General Public License, version 2.1", "the GNU LGPL v2.1"),
    "lgpl-3.0": ("the GNU Lesser General Public License, version 3", "the GNU LGPL v3"),
    "agpl-3.0": ("the GNU Affero General Public License, version 3", "the GNU AGPL v3"),
    "mpl-2.0": ("the Mozilla Public License, version 2.0", "the Mozilla Public License 2.0"),
    "bsd-2-clause": ("the BSD 2-Clause License", "the 2-Clause BSD License", "the Simplified BSD License"),
    "bsd-3-clause": ("the BSD 3-Clause License", "the 3-Clause BSD License", "the New BSD License", "a BSD-style license"),
    "isc": ("the ISC License",),
    "zlib": ("the zlib License",),
    "bsl-1.0": ("the Boost Software License, Version 1.0",),
    "epl-2.0": ("the Eclipse Public License 2.0", "the Eclipse Public License, Version 2.0"),
    "eupl-1.2": ("the European Union Public Licence 1.2",),
    "artistic-2.0": ("the Artistic License 2.0",),
    "unlicense": ("the terms of the Unlicense",),
    "ofl-1.1": ("the SIL Open Font License, Version 1.1",),
    "gfdl-1.3": ("the GNU Free Documentation License, Version 1.3",),
    "odbl-1.0": ("the Open Database License",),
    "cc0-1.0": ("CC0 1.0", "CC0 1.0 Universal"),
}
CC_PARTS = {"by": "Attribution", "sa": "ShareAlike", "nc": "NonCommercial", "nd": "NoDerivatives"}
CC_KINDS = ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd")
CC_VERSIONS = {"4.0": "International", "3.0": "Unported"}

# Texts of licenses and of their standard headers.
TEXTS = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject
to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE
OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "bsd-2-clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in
the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS
IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR
BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "bsd-3-clause-third": """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that
the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any
damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial
applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be
misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product
documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented
as being the original software. 3. This notice may not be removed or altered from any source distribution.""",
    "unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile,
sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any
means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the
software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We
intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.""",
    "bsl-1.0": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying
documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare
derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following""",
    "wtfpl": """Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long
as the name is changed.""",
    "apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or
implied. See the License for the specific language governing permissions and limitations under the License.""",
    "mpl-2.0-header": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed
with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "epl-2.0-header": """This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is
available at https://www.eclipse.org/legal/epl-2.0/""",
    "gpl-no-warranty": """This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty
of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
    "gpl-preamble": """The GNU General Public License is a free, copyleft license for software and other kinds of works. The licenses for most
software and other practical works are designed to take away your freedom to share and change the works.""",
    "gpl-verbatim": "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",
    "gfdl-header": """Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License""",
    "public-domain": "This work has been released into the public domain by its author.",
    "all-rights-reserved": "All rights reserved.",
}
#: The header of the GNU licenses: what it is about, the license and the version stand in it.
GNU_HEADER = "{what} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."
GNU = {"gpl-2.0": ("General Public License", "2"), "gpl-3.0": ("General Public License", "3"), "lgpl-2.1": ("Lesser General Public License", "2.1"), "lgpl-3.0": ("Lesser General Public License", "3"), "agpl-3.0": ("Affero General Public License", "3")}


def templates() -> dict[str, str]:
    """Name of each template (the license, and what of it) and its text."""
    names = {k: list(v) for k, v in NAMES.items()}
    for kind in CC_KINDS:
        for version, where in CC_VERSIONS.items():
            long = "-".join(CC_PARTS[p] for p in kind.split("-"))
            names[f"cc-{kind}-{version}"] = [f"CC {kind.upper()} {version}", f"a Creative Commons {long} {version} {where} License"]
    out = dict(TEXTS)
    for key, (name, version) in GNU.items():
        out[f"{key}-header"] = GNU_HEADER.format(what="This program", name=name, version=version)
    for key, forms in names.items():
        out[f"{key}:spdx"] = f"SPDX-License-Identifier: {key}"
        for i, form in enumerate(forms):
            for verb in VERBS:
                out[f"{key}:{verb}-{i}"] = f"{verb} under {form}"
    for file in sorted(files(__package__).joinpath("licenses").iterdir(), key=lambda f: f.name):
        if file.name.endswith(".txt"):
            out[f"{file.name.removesuffix('.txt')}-text"] = file.read_text("utf-8")
    return out


TEMPLATES = templates()

"""Titles, tags, headers and passages of common licences, several to a licence.

Titles and headers are the usual ones of files and of the licences' own instructions. A passage is 20 to 45 words that stand in the
licence's full text; long licences are known by their title with the opening of their text.
"""

_GNU = "This program is free software: you can redistribute it and/or modify it under the terms of the {} as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
_COPYLEFT = "{} Version {} Copyright (C) Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."
_CC = ["Licensed under {0}.", "This work is licensed under a Creative Commons {1} International License.", "Creative Commons {1} International Public License", "https://creativecommons.org/licenses/{2}"]


def _gnu(name: str, version: str, spdx: str) -> list[str]:
    return [_GNU.format(name, version), _COPYLEFT.format(name, version), f"Licensed under the {name}, version {version}.", f"{name} version {version}", f"Released under the {spdx.split('-')[0]}v{version[0]} license."]


def _cc(short: str, long: str, path: str) -> list[str]:
    return [t.format(short, long, path) for t in _CC]


TEXTS = {
    "AGPL-3.0": _gnu("GNU Affero General Public License", "3", "AGPL-3.0"),
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "Apache License 2.0",
        "Released under the Apache License 2.0.",
    ],
    "BSD-2-Clause": ["BSD 2-Clause License", "Released under the BSD 2-Clause License.", "Simplified BSD License"],
    "BSD-3-Clause": [
        "BSD 3-Clause License",
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "BSL-1.0": [
        "Boost Software License - Version 1.0 - August 17th, 2003",
        "Distributed under the Boost Software License, Version 1.0.",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software",
    ],
    "CC-BY-4.0": _cc("CC BY 4.0", "Attribution 4.0", "by/4.0"),
    "CC-BY-NC-4.0": _cc("CC BY-NC 4.0", "Attribution-NonCommercial 4.0", "by-nc/4.0"),
    "CC-BY-NC-ND-4.0": _cc("CC BY-NC-ND 4.0", "Attribution-NonCommercial-NoDerivatives 4.0", "by-nc-nd/4.0"),
    "CC-BY-NC-SA-4.0": _cc("CC BY-NC-SA 4.0", "Attribution-NonCommercial-ShareAlike 4.0", "by-nc-sa/4.0"),
    "CC-BY-ND-4.0": _cc("CC BY-ND 4.0", "Attribution-NoDerivatives 4.0", "by-nd/4.0"),
    "CC-BY-SA-4.0": _cc("CC BY-SA 4.0", "Attribution-ShareAlike 4.0", "by-sa/4.0"),
    "CC0-1.0": ["Creative Commons CC0 1.0 Universal", "https://creativecommons.org/publicdomain/zero/1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "EPL-2.0": [
        "Licensed under the Eclipse Public License, version 2.0.",
        "Eclipse Public License - v 2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at",
        "THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE. ANY USE, REPRODUCTION OR DISTRIBUTION OF THE PROGRAM CONSTITUTES RECIPIENT'S ACCEPTANCE OF THIS AGREEMENT.",
    ],
    "GPL-2.0": _gnu("GNU General Public License", "2", "GPL-2.0"),
    "GPL-3.0": _gnu("GNU General Public License", "3", "GPL-3.0"),
    "ISC": [
        "The ISC License",
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "LGPL-2.1": [*_gnu("GNU Lesser General Public License", "2.1", "LGPL-2.1"), _GNU.replace("program", "library").format("GNU Lesser General Public License", "2.1")],
    "LGPL-3.0": _gnu("GNU Lesser General Public License", "3", "LGPL-3.0"),
    "MIT": [
        "The MIT License",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "MPL-2.0": [
        "Mozilla Public License Version 2.0",
        "Licensed under the Mozilla Public License, version 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Released under the Unlicense.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
    "WTFPL": ["Do What The Fuck You Want To Public License", "Licensed under the WTFPL."],
    "Zlib": [
        "The zlib License",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely",
    ],
}
_SUFFIXES = {"AGPL-3.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0"}
for _name, _list in TEXTS.items():
    _list += [f"SPDX-License-Identifier: {x}" for x in ([_name, f"{_name}-only", f"{_name}-or-later"] if _name in _SUFFIXES else [_name])]

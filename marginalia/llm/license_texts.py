"""What works say of their licence, the notices that licences ask for, and how licence texts begin."""

from __future__ import annotations

#: Short statements; a negation among or before their words turns them round.
STATEMENTS: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("ISC", "Released under the ISC License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
]

#: Notices and passages that stand in files or licence texts.
NOTICES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("AGPL-3.0", "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the Software) to use, reproduce, display, distribute, execute, and transmit the Software."),
    ("ISC", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely."),
]

#: How licence texts begin. A file that begins so is the licence itself.
TITLES: list[tuple[str, str]] = [
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software Foundation, Inc."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("CC0-1.0", "CC0 1.0 Universal CREATIVE COMMONS CORPORATION IS NOT A LAW FIRM AND DOES NOT PROVIDE LEGAL SERVICES."),
    ("EPL-2.0", "Eclipse Public License - v 2.0 THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE (AGREEMENT)."),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc."),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 Copyright (C) 1991, 1999 Free Software Foundation, Inc."),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc."),
    ("MPL-2.0", "Mozilla Public License Version 2.0 1. Definitions 1.1. Contributor means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software."),
]

#: Identifiers that a tag may name, and the licence each stands for.
TAGS = {
    "AGPL-3.0-only": "AGPL-3.0", "AGPL-3.0-or-later": "AGPL-3.0", "Apache-2.0": "Apache-2.0", "BSD-2-Clause": "BSD-2-Clause", "BSD-3-Clause": "BSD-3-Clause", "BSL-1.0": "BSL-1.0",
    "CC-BY-4.0": "CC-BY-4.0", "CC-BY-NC-4.0": "CC-BY-NC-4.0", "CC-BY-SA-4.0": "CC-BY-SA-4.0", "CC0-1.0": "CC0-1.0", "EPL-2.0": "EPL-2.0",
    "GPL-2.0": "GPL-2.0", "GPL-2.0+": "GPL-2.0", "GPL-2.0-only": "GPL-2.0", "GPL-2.0-or-later": "GPL-2.0", "GPL-3.0": "GPL-3.0", "GPL-3.0+": "GPL-3.0", "GPL-3.0-only": "GPL-3.0", "GPL-3.0-or-later": "GPL-3.0",
    "ISC": "ISC", "LGPL-2.1-only": "LGPL-2.1", "LGPL-2.1-or-later": "LGPL-2.1", "LGPL-3.0-only": "LGPL-3.0", "LGPL-3.0-or-later": "LGPL-3.0", "MIT": "MIT", "MPL-2.0": "MPL-2.0", "Unlicense": "Unlicense", "Zlib": "Zlib",
}

#: Words that turn a statement round.
NEGATIONS = ["not", "no", "never", "without", "neither", "nor", "cannot", "isn't", "aren't", "wasn't", "won't", "formerly"]

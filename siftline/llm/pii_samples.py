"""A small labelled table for the field of ``pii``: sentences around marked slots, drawn from a seed.

A template is plain text with slots in braces; a slot written {kind|pattern} is a span of that kind. Patterns
are letters that stand for a drawn character (see ``_DRAWN``) or word; everything else stands for itself.
"""

from __future__ import annotations

import random
import re

# What the drawn parts are made of.
_SYLLABLES = "er the on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve ch sch ue ció que ment äh ß lich ung".split()
_HEX, _ALPHABET = "0123456789abcdef", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"

# Sentences with personal data.
_PRIVATE = (
    '{w} token = "{secret|<hex40>}" {W} {w}', 'token="{secret|<hex32>}"', "TOKEN = \"{secret|<HEX40>}\" {w}", "{w} api_key: {secret|<b64>} {w}",
    "{w} apikey={secret|<b64>}", "secret = '{secret|<b64>}'", "password: {secret|<pass>} {w}", "pwd={secret|<pass>}; {w}", "{w} access token {secret|<hex64>} {w}",
    "Authorization: Bearer {secret|<b64>}", "{w} secret key {secret|<hex32>}, {w}", '{w}!! token = "{secret|<hex40>}"*** {w}%%%', 'API key "{secret|<hex32>}".',
    "{w} call ({phone|ddd) ddd-dddd} {w}", "{w} {phone|(ddd) ddd-dddd} {w}", "phone: {phone|ddd-ddd-dddd}", "{w} tel. {phone|0dd ddddddd}, {w}", "mobile {phone|0ddd ddddddd} {w}",
    "{w} {phone|ddd-ddd-dddd}. {W}", "{w} {phone|+d (ddd) ddd-dddd} {w}", "{w}*** {phone|+dd dd ddddddd}### {w}", "Fax {phone|(0dd) dddddd}", "Telefon: {phone|0dd/ddddddd} {w}",
    "{w} {email|<low>.<low>@<low>.com} {w}", "email {email|<low> at <low> dot com} {w}", "{w} contact {email|<low> [at] <low> [dot] org}", "mail: {email|<low> (at) <low>.net}, {w}",
    "{W}. {email|<low>.dd@<low>d.<low>.com} {w}", "{w} {email|<low>_dd@<low>.org}### {w}",
    "{w} SSN {id|ddd-dd-dddd} {w}", "{w} {id|ddd-dd-dddd}, {w}", "ssn: {id|ddddddddd}", "passport {id|Xddddddd} {w}", "Passport No. {id|XXddddddd}", "IBAN {id|XXdd dddd dddd dddd dddd dd} {w}",
    "{w} iban: {id|XXdddddddddddddddddddd}", "social security {id|ddd-dd-dddd}", "tax id {id|dd-ddddddd} {w}",
)

# Sentences without.
_PLAIN = (
    "{w} {w} {w}. {W} {w}, {w} {w}.", "{W} {w} {W} {w}. {W} {W} {w}", "{U} {U}!! {U}, {U}!! {U}", "{w}### {w}%%% {w}*** {w}&&& {w}$$$", "{w} {W} {U} {w} {w}, {w}.", "{W}.", "{w}",
    "{w} dddd {w}", "{w} dddd-dddd, {w}", "pages ddd-ddd {w}", "{w} $dd.dd {w}", "{w} d,ddd,ddd {w}", "{w} dd:dd {w}", "on dddd-dd-dd {w}", "dd/dd/dddd {w}", "{W} {w} {w} {w}. {W} {w} {w} {w} {w} {w}. {W}, {w} {w}", "version d.dd.d {w}", "{w} dd% {w}",
    "commit <hex40> {w}", "sha256: <hex64>", "md5 <hex32> {w}", "checksum <hex32>", "order no. dddddddd {w}", "ISBN ddd-d-dd-dddddd-d {w}", "{w} ddd.ddd.dd.dd {w}", "{w} dddddddddddddddd {w}",
    "{w} dddd dddd dddd dddd {w}", "{w} dddddddddddddddddddd {w}", "{W} ddd {w} at {w} dot {w}", "{w} is {w}. {W} is {W}", "the key {w} of {w}", "a secret {w} {w}", "call {w} {w} at dd",
    "http://<low>.com/<low>/ddd {w}", "{w} <low>d {w}", "{w} (ddd) {w}", "{w} (d) {w}, (d) {w}", "Vol. dd, no. d, dddd", "{w} d. {W} {w} d. {W}", "{w} account {w} {w}", "password {w} {w}", "name {w} {w}",
    "{w} id {w}", "- {w}\t{w}", "* {w}", '"{w} {w}", {w}', "{w} ({w} {w}) {w}", "{w}; {w}: {w}", "# {W} {w}", "<{w}> {w} </{w}>", "{w}={w}&{w}=d", "is {w} the {W} at {w}", "{w} the @{w} {w}", "{w} a key = {w}",
    "{w} token {w} {w}", "{w} phone {w} {w}", "{w} mail {w} at {w}", "no. dd {w}", "{W} {W} {W} {w}", "copyright dddd {W} {W}", "license d.d {w}", "{w} the license {w}", "{w} +d {w}", "{w} -dd {w}", "{w} dd-dd-dd {w}",
    "Mr {w} {w}", "{w} security {w} {w}", "{w} mobile {w}", "at at at at {w}", "{w} at at. At At {w}", "{w} contact {w} at {W}",
)

_MARK = re.compile(r"\{(?:(\w+)\|)?([^{}]*)\}")
_DRAWN = re.compile(r"<\w+>|(?<![a-z])d+(?![a-z])|X")


def _word(draw: random.Random) -> str:
    return "".join(draw.choices(_SYLLABLES, k=draw.choices((1, 2, 3, 4), (4, 5, 3, 1))[0]))


def _filled(pattern: str, draw: random.Random) -> str:
    made = {
        "X": lambda: draw.choice("ABCDEFGHJKLMNPRSTUVWXYZ"), "<low>": lambda: _word(draw),
        "<hex32>": lambda: "".join(draw.choices(_HEX, k=32)), "<hex40>": lambda: "".join(draw.choices(_HEX, k=40)),
        "<HEX40>": lambda: "".join(draw.choices(_HEX, k=40)).upper(), "<hex64>": lambda: "".join(draw.choices(_HEX, k=64)),
        "<b64>": lambda: "".join(draw.choices(_ALPHABET, k=draw.randint(20, 44))), "<pass>": lambda: "".join(draw.choices(_ALPHABET, k=draw.randint(8, 14))) + draw.choice(("1", "9x")),
    }

    def drawn(m: re.Match) -> str:
        return "".join(draw.choices("0123456789", k=len(m.group()))) if m.group()[0] == "d" else made[m.group()]()

    return _DRAWN.sub(drawn, pattern)


def row(template: str, draw: random.Random) -> tuple[str, list[tuple[str, int, int]]]:
    """A text and its spans."""
    text, spans, at = "", [], 0
    for m in _MARK.finditer(template):
        text += _plain(template[at : m.start()], draw)
        kind, inner = m.groups()
        if kind:
            made = _filled(inner, draw)
            spans.append((kind, len(text), len(text) + len(made)))
        else:
            words = " ".join(_word(draw) for _ in range(draw.randint(1, 4)))
            made = {"w": words, "W": words[0].upper() + words[1:], "U": words.upper()}[inner]
        text += made
        at = m.end()
    return text + _plain(template[at:], draw), spans


def _plain(part: str, draw: random.Random) -> str:
    """Text between slots: runs of d, X and <...> that stand alone are drawn, words stay."""
    return re.sub(r"<\w+\d*>(?!\s*</)|(?<![A-Za-z])d+(?![A-Za-z])|(?<=>)d+", lambda m: _filled(m.group(), draw), part)


def rows(count: int, seed: int) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """``count`` labelled texts, a little more than half of them without personal data."""
    draw = random.Random(seed)
    return [row(draw.choice(_PRIVATE if draw.random() < 0.45 else _PLAIN), draw) for _ in range(count)]

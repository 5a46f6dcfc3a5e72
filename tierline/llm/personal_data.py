"""Personal data: exact patterns, and a linear-chain conditional random field
over word-shape features for the forms they miss.

The exact spans (email, ip, card, phone) are leftmost and do not overlap within
a kind. The tagger, trained from the labelled lines below, adds spelled-out
mail addresses (``tom at example dot com``), telephone numbers without a
country code or across a line break, numbers that stand beside each other and
the like; it never takes an exact span away.

Defined results: a null or empty text has no spans; a null id stays null and
its text is searched; rows that repeat are treated alike; of spans that start
together the kind listed first comes first; an empty table gives no rows; other
columns are ignored, whatever their names; texts are searched whole, in time
linear in their length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from .spans import Finder, Span, shape

# The character sets of the exact patterns.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A dotted number that fails from the first digit of a run of digits fails from
# the others too, so only first digits are tried; likewise for the others.
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# A mail address has an @ or a spelled at, then a dot or a spelled dot.
_SPELLED = re.compile(r"[A-Za-z0-9]\W*(?:@|\bat\b).*[A-Za-z0-9]\s*(?:\.|\W*\bdot\b)\W*[A-Za-z]{2,}", re.IGNORECASE | re.DOTALL)
_LONGEST_MAIL = 320
_EDGES = ".,;:!?*#%$&|\"'<>"

# The labelled table: one line per row, spans in braces.
LABELLED = """
write to {email anna.b3@mail.example.org} about it
mail {email jo_k@example.net} or come by
my address is {email tom.riley [at] example.com} thanks
send it to {email m.weber (at) post.example.de} today
contact {email lena [at] example [dot] org} for this
you can reach {email sam(at)example.com} as well
email {email kim[at]mail.example.net} first
{email joe at example dot com}
reach {email nina at example dot org} for help
write to {email paul at mail dot example dot net} please
mail {email lisa.k at example dot com} or call
it is {email ben_07 at example dot de} and the
contact {email maria at post dot example dot org} today
ask {email d.ross at example dot net} about the
{email olga AT example DOT com}
send to {email peter (at) example (dot) com} now
call {phone +1 (212) 555-0143} in the morning
call {phone (212) 555-0143} in the morning
the number is {phone (646) 555-0199} and he waits
ring {phone 212-555-0143} after nine
phone {phone 646-555-0177.} or write
tel {phone 415.555.0132} then ask
telephone {phone 030 555 01234} in the evening
mobile {phone +44 20 7946 0958} works too
fax {phone +49 30 555 0123} is old
ask for {phone (917) 555-0164}
phone: {phone 718-555-0101} or {phone 718-555-0102}
{phone 02 5550 1234} is the office
cell {phone 347.555.0198}
reach me at {phone (305) 555-0188} or there
from {ip 192.168.10.4} to {ip 10.0.0.12} it went
host {ip 203.0.113.77:8080} answered
server {ip 198.51.100.23} was down and the
they saw {ip 203.0.113.9} of in
the card {card 4111111111111111} was used
numbers {card 4111111111111111} {card 5500005555555559} there
and {card 5500005555555559} {card 4012888888881881} of the
pay with {card 4012 8888 8888 1881} please
card {card 3782-822463-10005} expired
the {card 4111111111111111} 1234567812345678 in of
to 1234567812345678 {card 5500005555555559} was
of 1234567812345678 4111111111111112 the and
thing 1234567812345678 in the
word 4111111111111112, there
the 9876543210987654 of
is 4012888888881882. And
version 2.0. of it
version 3. is out
under version 2.0 and 4.0 it
release 1.2.3 came before 1.2.10 then
about 300.400.500.600 nothing
in 1999 and 2005 there were
on 2021-03-04 at 10:30 we
on 12/05/2019 the
page 12 of 300 pages
it cost 1,200.50 for 3 items
between 10 and 20 of 100
chapter 5 section 6.2 says
section 4.1 and 4.2 and 4.3
order 48151623 is late
number 12345 is taken
isbn 978-3-16-148410-0 of the book
token = "9f8e7d6c5b4a39281706f5e4d3c2b1a0" here
key 3fa85f64-5717-4562-b3fc-2c963f66afa6 there
a1b2 c3d4 e5f6 g7h8
555-0143 is short
room 212 and 555
at 5 and at 6 in the 7
the 1st and 2nd and 3rd
@home and @work are tags
follow @anna and @tom42 there
meet at noon (at) the place
the at sign (at) is a sign
look at the dot on the map
he arrived at nine on the dot and left
at a dot in the line we stop
she works at example for the dot project
they met at noon and at dot level
we are at home and at work
the dot com years came at once
a dot of ink at the end
at the dot com company in the city
looked at each dot of it
at last
3 x 4 = 12
10% of 250 and $99
"""


def luhn(digits: str) -> bool:
    """Whether the check digit is right."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _ip_ok(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in text.split("."))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``: each @
    has one possible start, the run of local characters before it."""
    free = 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL:
            begin -= 1
        m = _DOMAIN.match(text, at + 1) if begin < at else None
        if m:
            yield begin, m.end()
        free = m.end() if m else at + 1
        at = text.find("@", free)


class PersonalData(Finder):
    kinds = ("email", "ip", "card", "phone")
    tagged_kinds = ("email", "ip", "card", "phone")
    labelled = LABELLED
    edges = _EDGES

    def exact(self, text: str) -> list[Span]:
        spans = [("email", s, e) for s, e in emails(text)]
        spans += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if _ip_ok(m[0])]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = _digits(m[0])
                if 14 <= len(digits) <= 19 and luhn(digits):
                    spans.append(("card", m.start(), m.end()))
        if "+" in text:
            spans += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
        return spans

    def own(self, token: str) -> list[str]:
        core = token.strip(_EDGES)
        digits = _digits(core)
        n = len(digits)
        out = [f"s={shape(core)}", f"d={n if n < 5 else '5-6' if n < 7 else n if n == 7 else '8-9' if n < 10 else '10-12' if n < 13 else '13-19' if n < 20 else '20+'}"]
        if n >= 13 and len(core) <= 32 and not any(c.isalpha() for c in core):
            out.append("luhn" if n <= 19 and luhn(digits) else "no-luhn")
        if core.count(".") == 3 and _IP.match(core):
            out.append("ip" if _ip_ok(_IP.match(core)[0]) else "no-ip")
        if "@" in core:
            out.append("mail" if next(emails(core), None) else "at")
        bare = core.strip("[]()").lower()
        if core.isalpha() and len(core) <= 10 or bare in ("at", "dot"):
            out.append(f"w={core.lower()}")
        if bare in ("at", "dot"):
            out.append(f"sign={bare}")
        return out

    def far(self, features: list[str]) -> list[str]:
        return [f for f in features if f.startswith("sign=")]

    def trim(self, kind: str, text: str, start: int, end: int) -> Span | None:
        while start < end and not (text[start].isalnum() or text[start] in "+("):
            start += 1
        while start < end and not (text[end - 1].isalnum() or text[end - 1] == ")"):
            end -= 1
        n = len(_digits(text[start:end]))
        fits = {"card": 12 < n < 20 and luhn(_digits(text[start:end])), "phone": 9 < n < 16,
                "ip": 3 < n, "email": end - start <= _LONGEST_MAIL and _SPELLED.search(text[start:end]) is not None}[kind]
        return (kind, start, end) if fits else None

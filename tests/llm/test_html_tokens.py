"""Tokens and visibility of HTML against the states of the standard's tokenizer, and pages that lost text before."""

import random
import re
import time

from talkweave.llm.html_text import page_text

SPACE = " \t\n\f\r"


def standard_text(page):
    """The characters that a page of inline elements shows: the standard's tokenizer, a state and a character at a time."""
    out, i, n = [], 0, len(page)
    state = "data"
    letter = lambda c: c.isascii() and c.isalpha()
    while True:
        c = page[i] if i < n else None
        i += 1
        if state == "data":
            if c is None:
                break
            if c == "<":
                state = "tag open"
            else:
                out.append(c)
        elif state == "tag open":
            if c == "!":
                if page.startswith("--", i):
                    i += 2
                    state = "comment start"
                else:
                    state = "bogus comment"
            elif c == "/":
                state = "end tag open"
            elif c == "?":
                state = "bogus comment"
            elif c is not None and letter(c):
                state = "tag name"
            else:
                out.append("<")
                i -= 1
                state = "data"
        elif state == "end tag open":
            if c is None:
                out.append("</")
                break
            if letter(c):
                state = "tag name"
            elif c == ">":
                state = "data"
            else:
                i -= 1
                state = "bogus comment"
        elif c is None:
            break
        elif state == "bogus comment":
            if c == ">":
                state = "data"
        elif state == "comment start":
            # <!--> and <!---> are whole comments; else up to -->
            rest = page[i - 1 :]
            if rest.startswith(">"):
                state = "data"
            elif rest.startswith("->"):
                i += 1
                state = "data"
            else:
                ends = [m for m in (re.search("--!?>", rest),) if m]
                if not ends:
                    break
                i = i - 1 + ends[0].end()
                state = "data"
        elif state == "tag name":
            state = "data" if c == ">" else "before name" if c in SPACE + "/" else state
        elif state == "before name":
            if c == ">":
                state = "data"
            elif c not in SPACE + "/":
                state = "name"
        elif state == "name":
            state = "data" if c == ">" else "after name" if c in SPACE else "before name" if c == "/" else "before value" if c == "=" else state
        elif state == "after name":
            if c == "=":
                state = "before value"
            elif c == ">":
                state = "data"
            elif c == "/":
                state = "before name"
            elif c not in SPACE:
                state = "name"
        elif state == "before value":
            if c in "\"'":
                state = c
            elif c == ">":
                state = "data"
            elif c not in SPACE:
                state = "unquoted"
        elif state == "unquoted":
            state = "data" if c == ">" else "before name" if c in SPACE else state
        elif c == state:
            state = "before name"
    return re.sub("[ \t\n\f\r]+", " ", "".join(out)).strip(" ")


def test_against_the_standards_states():
    rng = random.Random(31)
    bits = ["<", "</", ">", "<b", "<i ", "</b>", "<b>", "/", "=", '"', "'", " ", "\n", "a", "é", "ж", "İ", "1", "!", "<!", "<!--", "-->", "--!>", "-", "<?", "x=y", "k='v'", 'k="v"', "日"]
    for _ in range(30_000):
        page = "x" + "".join(rng.choices(bits, k=rng.randint(1, 14)))
        assert page_text(page) == standard_text(page), page


def test_no_text_is_lost():
    for first in "0123456789 .,;-+*~#%&()éжİßñ日😀\u00a0":
        assert page_text(f"<p>a <{first} b</p><p>rest</p>").endswith("rest"), first
        assert "rest" in page_text(f"<p>a </{first} b></p><p>rest</p>"), first
    assert page_text("<p>a <é b</p><p>rest</p>") == "a <é b\n\nrest"
    assert page_text("<p>1 <2 and <ж</p>more") == "1 <2 and <ж\n\nmore"
    for tag in ("script", "style", "title", "iframe", "noscript", "xmp", "noembed"):
        assert page_text(f"İ<{tag.upper()}>x</{tag.title()} ><p>İstanbul</p><p>rest</p>") == "İ\n\nİstanbul\n\nrest", tag
        assert page_text(f"<{tag}>x</{tag}y><p>no</{tag}\n>rest") == "rest", tag
    assert page_text("<ſcript>a</ſcript><p>rest") == "<ſcript>a\n\nrest"


def test_visibility():
    assert page_text("<div style='visibility:hidden'>no <b style='visibility: visible'>yes</b> no<p>no</p></div>") == "yes"
    assert page_text("<div style='display:none'>no <b style='visibility:visible;display:block'>no</b></div>end") == "end"
    assert page_text("<style>.h{visibility:hidden}.s{visibility:visible}</style><ul class=h><li>no<li class=s>two</ul>") == "- two"
    assert page_text("<p style='display:none;display:block'>yes") == "yes" and page_text("<style>p{display:none!important}</style><p style='display:block'>no") == ""
    assert page_text("<style>p{display:none!important}</style><p style='display:block!important'>yes") == "yes"


def test_selectors():
    page = "<style>%s{display:none}</style><div class='a c' id=d><section><p class='b e' lang=fr>one</p></section><p class=b>two</p></div><p class=b>three"
    text = lambda x: page_text(page % x).split()
    for x in (".a .b", "div p", "#d .b", "div.a.c p", "* .b .q, .a p", "div .b", "[class] > [class=b], section p", ".a section > p, .a > .b"):
        assert text(x) == ["three"], x
    for x in (".a > .b", "#d>p", "div > p.b", "body > div > .b"):
        assert text(x) == ["one", "three"], x
    for x in ("p.e", ".b.e", "section .b", "[lang='fr']", "p[lang]", "div section > .b", "#d section p"):
        assert text(x) == ["two", "three"], x
    for x in (".b .a", "p:hover", ".b + .b", "> p", "p >", "div > .q .b", ".a ~ p", "[lang=de]", "section > section p", ".a:not(.c) p"):
        assert text(x) == ["one", "two", "three"], x
    # the weightier rule wins, then the later
    weigh = lambda rules: page_text(f"<style>{rules}</style><div id=d class=a><p class=b>x") == "x"
    assert weigh("#d p{display:block}.a .b{display:none}") and not weigh(".a .b{display:none}p{display:block}") and weigh(".a .b{display:none}.a .b{display:block}") and not weigh("div p{display:none}p{display:block}")


def test_fields():
    assert page_text("<form>Name <input value='Bob B.'> <input type=submit value=Go><input type=hidden value=h><input type=checkbox value=c><input><button>Press</button></form>") == "Name Bob B. Go Press"


def test_long_pages():
    """Two megabytes in seconds, with rules of several parts too."""
    n = 2_000_000
    deep = "<style>.a .b .c{display:none} div > i{color:red}</style>"
    for page in ("<p>a <é " * (n // 8), "<SCRIPT>İ</SCRIPT>" * (n // 18), deep + "<div class=a>x</div>" * (n // 20), "<b a='x' c=\"y\" d=e f>t</b> " * (n // 30), "</é " * (n // 4), "<b " * (n // 3), "<input value=a>" * (n // 15)):
        begin = time.process_time()
        page_text(page)
        assert time.process_time() - begin < 12, page[:20]

"""Plain Python parts against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from centigram.llm import bpe, html, mixing, neighbours, pii, ranking, rules, scoring, stats
from centigram.llm.queries import tokenizer_path

SPACE = " \t\n\x0b\x0c\r"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def plain_counts(text):
    w = words(text)
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_counts_match_brute_force():
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice(["a", "b", "é", " ", "\n", "\t", "#", "\x1c", " ", "a b c ", "|"]) for _ in range(rng.randrange(40)))
        assert stats.describe(text.encode())[:5] == plain_counts(text)


PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([ \-]?[0-9])+",
    r"\+[0-9][ ().0-9\-]+[0-9]",
)


def plain_spans(text):
    out = []
    for k, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            good = (True, k == 1 and all(int(x) <= 255 for x in m[0].split(".")), 14 <= len(d) <= 19 and pii.luhn(d), 10 <= len(d) <= 15)[k]
            if good:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_match_the_patterns():
    rng = random.Random(2)
    parts = ["1", "22", "a", "@", ".", " ", "-", "+", "(", ")", "x.y", "b@c.de", "300", "4111 1111 1111 1111", "+1 (743) 555-3824", "é"]
    for _ in range(8000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(24)))
        assert pii.candidates(text)[0] == plain_spans(text)


def test_crf_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(0)
    rows, tags = rng.integers(0, pii.CLASSES, (3, 12)), rng.integers(0, pii.TAGS, (3, 12))
    p = {k: v.astype(np.float64) for k, v in pii.initial().items()}

    def loss(p):
        e = pii.emissions(p, rows)
        total = 0.0
        for j in range(3):
            score = e[j, 0].astype(float)
            path = e[j, 0, tags[j, 0]]
            for t in range(1, 12):
                score = e[j, t] + pii.logsumexp(score[:, None] + p["trans"], 0)
                path += e[j, t, tags[j, t]] + p["trans"][tags[j, t - 1], tags[j, t]]
            total += pii.logsumexp(score, 0) - path
        return total / 3

    slope = pii.gradient(p, rows, tags)
    for name in ("trans", "bias", "out", "hf", "xb", "embed"):
        at = np.unravel_index(int(np.abs(slope[name]).argmax()), slope[name].shape)
        up, down = ({k: v.copy() for k, v in p.items()} for _ in range(2))
        up[name][at] += 1e-2
        down[name][at] -= 1e-2
        assert (loss(up) - loss(down)) / 2e-2 == pytest.approx(slope[name][at], rel=0.05, abs=2e-3)


def test_ids_equal_the_library_for_any_text(monkeypatch):
    monkeypatch.setattr(bpe, "MEAN_CHUNK", 8)
    tokenizer = bpe.tools(tokenizer_path())
    encoder, decoder = bpe.Encoder(tokenizer), bpe.Decoder(tokenizer)
    rng = random.Random(3)
    parts = ["a", "b", " ", "  ", "\n", "\t", "é", "中", " ", " ", "\x1c", "'s", "1", "!", "<|endoftext|>", "<|endof", "😀", "\r\n", " the", "\x00"]
    for _ in range(2000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(60)))
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        got = encoder.encode(text)
        assert np.frombuffer(got, "<u4").tolist() == ids
        assert decoder.decode(got) == tokenizer.decode(ids, skip_special_tokens=False)
    assert encoder.reused


def test_rows_of_the_language_model_sum_to_one_and_learn():
    counts = np.zeros((20, 20))
    counts[np.arange(20), (np.arange(20) + 1) % 20] = 500
    logs = scoring.train(counts, width=16, steps=300)
    assert np.allclose((10**logs).sum(axis=1), 1)
    assert (logs[np.arange(20), (np.arange(20) + 1) % 20] > np.log10(0.3)).all()
    assert np.allclose(scoring.train(np.zeros((4, 4))), -np.log10(4))


def test_leaves_partition_the_quotas():
    quota = np.array([0, 7, 1000, 13])
    found = list(mixing.leaves(quota, 9, 0, 9))
    assert [f[0] for f in found] == list(range(9))
    assert (sum(f[2] for f in found) == quota).all()
    for s in range(len(quota)):
        ends = 0
        for _, start, count in found:
            assert start[s] == ends
            ends += count[s]
    again = [f for k in range(9) for f in mixing.leaves(quota, 9, k, k + 1)]
    assert all((a[2] == b[2]).all() for a, b in zip(found, again, strict=True))


def test_graph_finds_its_neighbourhoods():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 16))
    x = np.repeat(centres, 20, axis=0) + 0.05 * rng.normal(size=(800, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = neighbours.Graph(x.astype(np.float32))
    beam = graph.audited(0.93)
    graph, beam = neighbours.Graph.unpacked(graph.packed(beam))
    want = x @ x.T >= 0.93
    hit = sum(want[k][graph.around(x[k].astype(np.float32), 0.93, beam)].sum() for k in range(800))
    assert hit >= 0.99 * want.sum()


def test_rules_and_ranking_separate_what_can_be_separated():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, len(stats.RATIOS)))
    bad = (x[:, 2] > 1) | ((x[:, 4] < -1) & (x[:, 5] > 0))
    found = rules.learn(x, bad, stats.RATIOS)
    caught = np.zeros(len(x), bool)
    for rule in found:
        caught |= rules.covers(rule, x, stats.RATIOS)
    assert (caught == bad).mean() > 0.95
    easy = x[:, 2] > 1
    ranker = ranking.fit(x, (~easy).astype(int))
    z = ranking.design(x, np.array(ranker.centre), np.array(ranker.scale)) @ np.array(ranker.weights)
    assert ((z < ranker.threshold) == easy).mean() > 0.97
    assert rules.learn(x, np.zeros(600, bool), stats.RATIOS) == []
    assert ranking.fit(x[:0], np.zeros(0, int)).threshold == 0


def test_ranking_weighs_all_pairs():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, len(stats.RATIOS)))
    good = (x[:, 1] + x[:, 3] + rng.normal(size=400) > 0).astype(int)
    ranker = ranking.fit(x, good)
    z = ranking.design(x, np.array(ranker.centre), np.array(ranker.scale))
    ahead = z[good == 1][:, None] - z[good == 0]
    p = 1 / (1 + np.exp(ahead @ np.array(ranker.weights)))
    gradient = ranking.RIDGE * np.array(ranker.weights) - (ahead * p[..., None]).mean(axis=(0, 1))
    assert np.abs(gradient).max() < 1e-3


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("plain", "plain"),
        ("<p>a<p>b &amp; c", "a b & c"),
        ("<body><nav><a href=x>Menu</a></nav><article><h1>T</h1><p>One <i>t</i>wo.</p><div class=comments>no</div></article><footer>f</footer>", "T One two."),
        ("<body><div id=sidebar><p>side text of some length</p></div><div><h1>Title</h1><div><p>Para one is long enough.</p><p>Para two.</p></div></div><form>x</form>", "Title Para one is long enough. Para two."),
        ("<article></article>", ""),
        ("<script>var a='<p>x</p>'</script>", ""),
    ],
)
def test_main_text(page, text):
    assert html.main_text(page) == text


LONG = "A sentence of the article that runs on for long enough to be read as prose, with a clause or two in it."


@pytest.mark.parametrize(
    "inside, kept",
    [
        ('<p>See <a href="/travel/hidden-valley">the valley</a> now.</p>', "See the valley now."),
        ('<p>See <a href="/view?id=comments">the view</a> now.</p>', "See the view now."),
        ('<p title="A hidden gem">A gem.</p>', "A gem."),
        ('<p data-note="style=display:none" data-id=comments>Plain.</p>', "Plain."),
        ('<div aria-hidden="false">Shown.</div>', "Shown."),
        (f'<section id="discussion"><h2>Discussion</h2><p>{LONG}</p><p>{LONG}</p></section>', f"Discussion {LONG} {LONG}"),
        ('<h2 class="share header">Market share</h2>', "Market share"),
        ('<p>The <span class="ad">word</span> stays.</p>', "The word stays."),
        ('<div aria-hidden="true">Gone.</div>', ""),
        ("<p hidden>Gone.</p>", ""),
        ("<p class=x hidden=until-found>Gone.</p>", ""),
        ('<p style="color: red; DISPLAY : none">Gone.</p>', ""),
        ('<div role="navigation">Gone.</div>', ""),
        ('<div class="comments"><h3>Comments</h3><div class="comment"><a href=u>Bob</a> <span>1 May</span><p>Nice!</p><a href=r>Reply</a></div></div>', ""),
    ],
)
def test_attributes_drop_only_what_they_say(inside, kept):
    page = f"<body><nav><a href=x>Menu</a></nav><article><h1>T</h1><p>{LONG}</p><p>{LONG}</p>{inside}<p>End.</p></article></body>"
    assert html.main_text(page) == " ".join(f"T {LONG} {LONG} {kept} End.".split())


def test_a_marked_page_is_read():
    assert html.main_text(f"<body><div class=widget><p>{LONG}</p><p>{LONG}</p></div><p>short</p></body>").startswith(f"{LONG} {LONG}")


@pytest.mark.parametrize(
    "text, kind, piece, added",
    [
        ("mail müller@web.de now", 0, "müller@web.de", True),
        ("see mailto:a@b.co now", 0, "mailto:a@b.co", False),
        ("see (a@b.co) now", 0, "(a@b.co)", False),
        ("see a@b.co'c@d.co now", 0, "a@b.co'c@d.co", False),
        ("host 2001:db8::17 up", 1, "2001:db8::17", True),
        ("host 10[.]0[.]0[.]7 up", 1, "10[.]0[.]0[.]7", True),
        ("host 10 . 0 . 0 . 7 up", 1, "10 . 0 . 0 . 7", True),
        ("host 300.1.2.3 up", 1, "300.1.2.3", False),
        ("host 10[.]0[.]0[.]700 up", 1, "10[.]0[.]0[.]700", False),
        ("at 12:30:45 up", 1, "12:30:45", False),
        ("card 4111.1111.1111.1111 ok", 2, "4111.1111.1111.1111", True),
        ("card 4111/1111/1111/1111 ok", 2, "4111/1111/1111/1111", True),
        ("card 4111  1111  1111  1111 ok", 2, "4111  1111  1111  1111", True),
        ("card 4111 1111 1111 1111 12/27", 2, "4111 1111 1111 1111", True),
        ("card 4111.1111.1111.1112 ok", 2, "4111.1111.1111.1112", False),
        ("number 41111111111111110000000 ok", 2, "4111111111111111", False),
        ("call +1 743 555 3824 20260105 ok", 3, "+1 743 555 3824", True),
        ("call +1 (743) 555-3824) ok", 3, "+1 (743) 555-3824)", False),
    ],
)
def test_added_spans(monkeypatch, text, kind, piece, added):
    s = text.index(piece)
    span = (s, kind, s + len(piece))
    monkeypatch.setattr(pii, "decoded", lambda p, rows: [[span] for _ in rows])
    [(base, more)] = pii.find({}, [text])
    assert base == pii.candidates(text)[0]
    assert more == ([span] if added else [])


def test_an_added_span_grows_by_the_base_span_that_it_meets(monkeypatch):
    monkeypatch.setattr(pii, "decoded", lambda p, rows: [[(0, 0, len("müller@web."))]])
    assert pii.find({}, ["müller@web.de now"]) == [([(2, 0, 13)], [(0, 0, 13)])]
    monkeypatch.setattr(pii, "decoded", lambda p, rows: [[(0, 0, len("a@web."))]])
    assert pii.find({}, ["a@web.de now"]) == [([(0, 0, 8)], [])]

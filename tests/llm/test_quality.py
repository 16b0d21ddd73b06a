import pytest

from deidflow.llm import quality


def brute(text):
    text = text or ""
    words = text.encode().split()
    lines = [x for x in text.split("\n") if x.encode().split()]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    return len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside)


def test_counts_equal_brute_force(docs, prose):
    again = prose(6)
    texts = [None, "", " \n\t", "a", prose(40), again + "\n" + again + "\n" + again, "x\nx\n\nx y#*\n", "é 日本 " * 9, prose(3000), "a\x1cb c", "w " * 12]
    got = {r.doc_id: r for r in quality.judge(docs([(k, t, f"s{k % 2}") for k, t in enumerate(texts)])).collect()}
    for k, t in enumerate(texts):
        r = got[k]
        want = brute(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])


def test_hosts_are_judged_with_a_prior(docs, prose):
    rows = [(k, prose(30), "good") for k in range(40)] + [(100 + k, "x", "bad") for k in range(60)] + [(160 + k, prose(30), "bad") for k in range(3)]
    rows += [(300, "x", "tiny"), (301, prose(30), "tiny"), (302, prose(30), None)]
    got = {r.doc_id: r for r in quality.judge(docs(rows)).collect()}
    assert all(got[k].kept for k in range(40)) and not any(got[k].kept for k in range(100, 163))
    assert not got[161].base_failed and not got[161].host_ok and got[301].kept and got[302].kept


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(None, "a b c d e f g h i j k", "s")] * 2])
def test_edges(docs, rows):
    assert quality.judge(docs(rows)).count() == len(rows)
    kept = quality.keep(docs(rows))
    assert kept.columns == docs(rows).columns and kept.count() == (2 if rows and rows[0][0] is None else 0)

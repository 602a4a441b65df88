from tapework.llm import licenses


def test_every_notice_has_its_span():
    scanner = licenses.Scanner()
    names = ["mit", "bsd", "mit", "isc"] * 12 + ["mit"]
    text, want, at = "", [], 0
    for i, name in enumerate(names):
        head = " ".join(f"part{i}x{j}" for j in range(20)) + " "
        text += head + licenses.TEMPLATES[name] + "\n"
        n = len(licenses.words(licenses.TEMPLATES[name]))
        want.append((name, at + 20, at + 19 + n))
        at += 20 + n
    spans = scanner.scan(text)["spans"]
    assert sorted(x[:3] for x in spans if x[3] > 0.95) == sorted(want)
    for label in licenses.TEMPLATES:
        own = sorted(x[1:3] for x in spans if x[0] == label)
        assert all(a[1] < b[0] for a, b in zip(own, own[1:]))
    assert all(x[3] >= licenses.COVERED for x in spans if sum(y[0] == x[0] for y in spans) > 1)


def test_chains_reach_past_many_runs_inside_the_gap():
    template = " ".join(f"w{i}" for i in range(60)) + " " + " ".join(f"a{i} b{i}" for i in range(60))
    scanner = licenses.Scanner({"x": template}, {}, long=2, gap=200)
    # Behind the first half stand 60 short runs of the second half in reverse order, then a run that follows the first half.
    text = " ".join(f"w{i}" for i in range(60)) + " " + " ".join(f"a{i} b{i}" for i in reversed(range(1, 60))) + " z " + " ".join(f"a{i} b{i}" for i in range(20))
    best = max(x[3] for x in scanner.scan(text)["spans"])
    assert best >= (60 + 40) / 180

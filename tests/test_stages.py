from sightline.operators.stages import Stage, execute, fingerprint, until_settled


def test_stages():
    files, ran = {"raw"}, []

    def make(name, out, fail=False):
        def run():
            ran.append(name)
            if fail:
                raise ValueError("bad")
            files.add(out)

        return run

    one = Stage("one", make("one", "a"), ("raw",), ("a",), {"k": 1})
    two = Stage("two", make("two", "b", True), ("a",), ("b",))
    three = Stage("three", make("three", "c"), ("b",), ("c",))
    there = files.__contains__
    assert [r[1] for r in execute([one, two, three], there, dry=True)] == ["planned"] * 3 and not ran
    log = execute([one, two, three], there)
    assert [r[1] for r in log] == ["ok", "failed", "not_run"] and log[1][4] == "ValueError: bad" and ran == ["one", "two"]
    two.required, two.run = False, make("two", "b", True)
    assert [r[1] for r in execute([one, two, three], there, {"one": fingerprint(one)})] == ["skipped", "failed", "missing_input"]
    changed = Stage("one", one.run, ("raw",), ("a",), {"k": 2})
    assert [r[1] for r in execute([changed], there, {"one": fingerprint(one)})] == ["ok"]
    assert execute([Stage("x", one.run, ("none",))], there)[0][1:2] == ("missing_input",)


def test_until_settled():
    x = [8.0]

    def step():
        x[0] = max(1.0, x[0] / 2)

    assert until_settled(lambda: x[0], step, 20) == (4, 1.0)
    x[0] = 8.0
    assert until_settled(lambda: x[0], step, 2) == (2, 2.0)

from tidemark.llm import caches


def test_one_owner_at_a_time(monkeypatch):
    monkeypatch.setattr(caches, "_clear", {})
    monkeypatch.setattr(caches, "_owner", [""])
    gone = []
    caches.claim("a", lambda: gone.append("a"))
    caches.claim("a", lambda: gone.append("a"))
    assert gone == []
    caches.claim("b", lambda: gone.append("b"))
    assert gone == ["a"]
    caches.claim("a", lambda: gone.append("a"))
    assert gone == ["a", "b"]

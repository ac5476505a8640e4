import quire


def test_exports():
    for name in quire.__all__:
        assert getattr(quire, name) is not None

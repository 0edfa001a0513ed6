from pagelode import CrawlOptions, options_from


def test_sections_over_defaults():
    got = options_from({"crawler": {"max_depth": 2, "start_urls": ["a", "b"], "unknown": 1}, "kafka": {"batch_size": 9},
                        "elasticsearch": {"bulk_size": 7}, "redis": {"lease_seconds": 60}, "domains": {"budgets": {"a.edu": 5}}})
    assert (got.max_depth, got.start_urls, got.url_batch_size, got.bulk_size, got.lease_seconds, got.domain_budgets) == (
        2, ("a", "b"), 9, 7, 60, {"a.edu": 5})
    assert got.max_pages == CrawlOptions().max_pages


def test_flat_names_hide_the_section():
    got = options_from({"max_pages": 5, "crawler": {"max_depth": 9}})
    assert (got.max_pages, got.max_depth) == (5, 3)


def test_nothing_given():
    assert options_from(None) == options_from({}) == CrawlOptions()
    assert options_from({"crawler": None, "redis": None}) == CrawlOptions()

def all_checks():
    """The catalog with every check registered."""
    from checks import calendars, catalog, configs, dashboards, metrics, runs  # noqa: F401

    return catalog

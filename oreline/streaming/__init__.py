"""Streams.

The toolkit has no stateful streaming operator. Text expressions, JSON flattening, page parsing
and selectors, and scoring with a fitted network keep no state and are used on a streaming
DataFrame as they are; ``tests/test_pages.py`` runs the page operators on one.
"""

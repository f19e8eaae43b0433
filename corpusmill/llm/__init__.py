"""Training-data operators: filters, classifiers, deduplication, tokenizing, chat formatting and search.

Nothing outside this subpackage imports it. ``queries`` holds the thin queries, ``oracle`` their SQL."""

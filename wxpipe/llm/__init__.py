"""Operators that turn raw documents, pages and conversations into training data.

Nothing outside this folder (but for the registration of its queries) imports it.
"""

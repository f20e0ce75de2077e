"""Readers and writers of seeds, messages, posts, pages and file lists."""

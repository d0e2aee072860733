"""Readers and writers of the files a crawl leaves behind."""

from macroloom.sources import archives, csvs, json_docs, pages, snapshots, text_lines, xml_docs

__all__ = ["archives", "csvs", "json_docs", "pages", "snapshots", "text_lines", "xml_docs"]

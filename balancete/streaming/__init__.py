from .invoices import invoice_file_stream, start_invoice_stream

__all__ = ["invoice_file_stream", "start_invoice_stream"]

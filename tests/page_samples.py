"""Stored page of each board, small but with the elements the extraction looks at."""

BOARD_A = '''<html><div class="job-desc x"><h1 class="title"> Dev <b>Senior</b></h1><a class="job-company-name">ACME</a></div>
<div class="bg-blue"><li><strong>Địa điểm</strong><p><a href="/hn">Hà Nội</a></p></li><li><strong>Ngày cập nhật</strong><p>03/11/2025</p></li><li><strong>Ngành nghề</strong><p><a>IT</a>,<a>Web</a></p></li><li><strong>Lương</strong><p>15 Tr - 20 Tr VND</p></li></div>
<div class="detail-row"><h2 class="detail-title">Mô tả công việc</h2><p>Dòng 1<br>Dòng 2</p><p>Python &amp; SQL</p></div>
<div class="detail-row"><h2 class="detail-title">Phúc lợi</h2><ul class="welfare-list"><li> Thưởng </li><li>BH</li></ul></div>
<div class="info-place-detail"><span>Số 1</span></div>
<div><h3 class="detail-title">Thông tin khác</h3><div class="content_fck"><ul><li>Lương: 15 Tr - 20 Tr VND</li><li>Thời gian làm việc: T2-T6</li></ul></div></div></html>'''

BOARD_B = '''<div class="job-detail__body"><div class="job-detail__body-left"><div><div class="job-detail__info--section-content-title">Mức lương</div><div class="job-detail__info--section-content-value">10 - 20 triệu</div></div>
<div class="job-description"><div class="job-description__item"><h3>Mô tả công việc</h3><div class="job-description__item--content">a<p>b</p></div></div><div class="job-description__item"><h3>Quyền lợi</h3><div class="job-description__item--content"><p>x</p><p> </p><p>y</p></div></div><div class="job-description__item"><h3>Địa điểm làm việc</h3><div class="job-description__item--content"><div>- Hà Nội: Số 9</div></div></div><div class="job-description__item"><h3>Thời gian làm việc</h3><div class="job-description__item--content">T2</div></div></div></div>
<div class="job-detail__body-right"><div class="box-general-group-info-title">Cấp bậc</div><div class="box-general-group-info-value">NV</div></div></div><h1 class="job-detail__title">T</h1>'''

BOARD_C_LIST = '''<div class="job-card-1 job-item"><h2><a href="/viec-1">Mới Dev Java</a></h2><div class="company"><a>CoA</a></div><span class="salary">$1,000</span><span class="location">HN</span><div class="date">hôm nay</div><label class="skill">Java</label><label class="skill">SQL</label></div><div class="job-item"><p>no title</p></div>'''

BOARD_C_DETAIL = '''<div class="sc-1671001a-4 sc-1671001a-1"><div class="sc-1671001a-6">mota</div></div><div class="sc-1671001a-4"><div class="sc-1671001a-6">yeucau<br>2</div></div><div class="sc-c683181c-0"><div class="sc-c683181c-1"><p class="sc-ab270149-0 jlpjAq">Thưởng</p><div class="sc-c683181c-2">T13</div></div></div><div class="sc-7bf5461f-0"><div class="sc-7bf5461f-1"><label class="sc-ab270149-0 dfyRSX">NGÀY ĐĂNG</label><p class="sc-ab270149-0 cLLblL">03/11/2025</p></div><div class="sc-7bf5461f-1"><label class="sc-ab270149-0 dfyRSX">KỸ NĂNG</label><p class="sc-ab270149-0 cLLblL">Java, SQL</p></div></div><div class="sc-a137b890-0"><div class="sc-a137b890-1"><p class="sc-ab270149-0 cLLblL">Q1</p></div></div>'''

BOARD_D = '''<!-- Last updated: "2025-11-03 23:49:10 +0700" --><div class="job-header-info"><h1>DE</h1></div><div class="employer-name">E</div><div class="salary">1,000 - 2,000 USD</div>
<div class="job-show-info"><span>Ha Noi</span><span>Hybrid</span><span>Posted 1 day ago</span><div class="imb-4 imb-xl-3 d-flex flex-column flex-xl-row igap-3 align-items-xl-baseline"><a>Python</a><a>Spark</a></div><div class="imb-4 imb-xl-3 d-flex flex-column flex-xl-row igap-3 align-items-xl-baseline"><a>Data</a></div></div>
<div class="imy-5 paragraph"><p>desc</p><p>b</p></div><div class="imy-5 paragraph">req</div><div class="imy-5 paragraph">ben</div>
<section class="x job-show-employer-info y"><h3>E JSC</h3><div class="imt-5 imt-xl-4">decl</div><div class="row ipy-2"><div>Company size</div><div>10-50</div></div><div class="row ipy-2"><div>Country</div><div>VN</div></div></section>'''
